from __future__ import annotations

import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from samples import ROOTS, awkward, frame, prose, texts

import corpus_pipeline
from winnow.llm import crf, dart, langid


def bag(text: str) -> Counter:
    words = text.encode().lower().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def similarity(a: Counter, b: Counter) -> float:
    common = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - common
    return common / total if total else 1.0


def groups(rows) -> dict[int, int]:
    bags = {i: bag(t or "") for i, t, _ in rows}
    root = {i: i for i in bags}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(bags), 2):
        if similarity(bags[a], bags[b]) >= 0.8:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in bags}


def near_copies():
    rng = random.Random(11)
    rows = texts(2, 12)
    base = prose(rng, "en", 150).split()
    for i in range(60):  # pairs of copies are at times under 0.8, their chain is not
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = rng.choice(ROOTS["de"])
        rows.append((500 + i, " ".join(own), "en"))
    rows += [(700 + i, " ".join(base[:120] + prose(rng, "fr", 60).split()), "en") for i in range(12)]
    return rows


@pytest.mark.parametrize("few, block", [(16, 512), (2, 5)])
def test_groups_agree_with_all_pairs(spark, monkeypatch, few, block):
    monkeypatch.setattr(dart, "FEW", few)
    monkeypatch.setattr(dart, "BLOCK", block)
    rows = near_copies() + [r for r in awkward() if r[0] is not None]
    found = dart.near_duplicates(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: r.group_id for r in found} == groups(rows)


def test_groups_of_rows_without_keys_and_of_none(spark):
    rows = [(None, "a b c", "en"), (3, "a b c", "en"), (3, "a b c", "en")]
    found = dart.near_duplicates(frame(spark, rows)).collect()
    assert [(r.doc_id, r.group_id) for r in found] == [(None, 3), (3, 3), (3, 3)]
    lone = dart.near_duplicates(frame(spark, [(None, "a b c", "en")] * 2)).collect()
    assert [(r.doc_id, r.group_id) for r in lone] == [(None, None)] * 2
    assert dart.near_duplicates(frame(spark, [])).count() == 0


def test_texts_of_one_key_are_told_apart(spark):
    a, b, c = (prose(random.Random(i), "en", 30) for i in range(3))
    rows = [(1, a, "en"), (1, b, "de"), (2, b, "fr"), (None, c, "x"), (None, c, "x"), (None, a, "x"), (4, None, "n")]
    found = dart.first_of_groups(frame(spark, rows))
    assert found.columns == frame(spark, rows).columns
    kept = sorted(((r.doc_id, r.text, r.lang) for r in found.collect()), key=str)
    assert kept == sorted([(1, a, "en"), (1, b, "de"), (None, c, "x"), (4, None, "n")], key=str)
    renamed = frame(spark, rows).withColumnRenamed("part", "row")
    assert dart.first_of_groups(renamed).columns == renamed.columns


@pytest.mark.parametrize("few, block", [(16, 512), (1, 7)])
def test_left_over_rounds_return_few_links_and_lose_none(spark, monkeypatch, few, block):
    monkeypatch.setattr(dart, "FEW", few)
    monkeypatch.setattr(dart, "BLOCK", block)
    monkeypatch.setattr(dart, "CENTRES", 1)
    counted = []
    across = dart._links_across

    def watched(left, right, *rest):
        links = across(left, right, *rest)
        counted.append((links.count(), left.select("id").distinct().count()))
        return links

    monkeypatch.setattr(dart, "_links_across", watched)
    rng = random.Random(17)
    rows = []
    for family in range(4):
        base = prose(rng, "en", 120).split()
        for i in range(70):
            own = list(base)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(len(own))] = rng.choice(ROOTS["de"])
            rows.append((100 * family + i, " ".join(own), "en"))
    found = dart.near_duplicates(frame(spark, rows)).collect()
    assert {r.doc_id: r.group_id for r in found} == groups(rows)
    if few == 1:
        assert all(links <= 25 * texts for links, texts in counted)


def test_signatures_agree_as_often_as_the_weighted_similarity():
    rng = np.random.default_rng(12)
    size, tries = 64, 60
    for kind in range(3):
        agreed, expected = [], []
        for _ in range(tries):
            element = rng.integers(1, 2**62, 30).astype(np.uint64)
            a = rng.choice([0.3, 1.0, 2.5, 7.0], 30) if kind else np.ones(30)
            b = np.where(rng.random(30) < 0.7, a, rng.choice([0.5, 1.0, 4.0], 30))
            b[: 5 * kind] = 1e-9
            doc = np.repeat([0, 1], 30)
            signed = dart.dart_signatures(doc, np.tile(element, 2), np.concatenate([a, b]), 2, size)
            agreed.append((signed[0] == signed[1]).mean())
            expected.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        assert np.mean(agreed) == pytest.approx(np.mean(expected), abs=0.03)


def test_shingles_are_counted_with_repeats():
    text = pa.array(["x y z x y z x y z", "one two", "", "One  TWO"])
    doc, _, weight, digest = dart.shingles_of(text)
    assert sorted(weight[doc == 0]) == [1, 2, 2] and weight[doc == 1].tolist() == [1]
    assert (digest[1] == digest[3]).all() and not digest[2].any() and (doc != 2).all()


def pipeline_sizes(spark, tmp_path, rows, labels):
    folder = str(tmp_path / "sf")
    frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_pipeline_stages_work_on_what_the_one_before_kept(spark, tmp_path):
    rng = random.Random(13)
    langs = sorted(ROOTS)
    rows = [(i, prose(rng, langs[i % 3], 60), langs[i % 3]) for i in range(120)]
    for i in range(0, 120, 4):
        rows[i] = (i, rows[i][1] + " Zargblat zargbling quuxfoo zargblats", rows[i][2])
    labels = [(i, 1, int(i % 4 == 0)) for i in range(120)]
    rows += [(5000 + i, t, g) for i, t, g in near_copies()] + [r for r in awkward() if r[0] is not None]
    folder = pipeline_sizes(spark, tmp_path, rows, labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = langid.learn_dictionaries(docs)
    own = {r.doc_id for r in langid.identify(docs, known).where("NOT rejected").collect()}
    stages = dict(corpus_pipeline.STAGES)
    first = stages["language ID"](spark, docs, folder)
    assert first.columns == docs.columns and {r.doc_id for r in first.collect()} == own
    second = stages["toxicity"](spark, first, folder)
    sample = crf.labelled_sample(first, spark.read.parquet(f"{folder}/labels.parquet"), "toxic", 1000, 1000)
    clean = {r.doc_id for r in crf.score(first, crf.fit(*sample)).where("predicted = 0").collect()}
    assert second.columns == docs.columns and {r.doc_id for r in second.collect()} == clean
    assert len(clean & set(range(0, 120, 4))) <= 3 and len(set(range(120)) - clean) <= 33
    third = stages["MinHash near-dedup"](spark, second, folder)
    left = groups([r for r in rows if r[0] in clean])
    keys = [r.doc_id for r in third.collect()]
    assert third.columns == docs.columns and sorted(keys) == sorted(i for i, g in left.items() if i == g)
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in packed} == set(keys)


def test_pipeline_over_empty_tables(spark, tmp_path):
    folder = pipeline_sizes(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0
