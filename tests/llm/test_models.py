from __future__ import annotations

import itertools
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from samples import awkward, crc_mod, frame, prose, texts

from winnow.llm import chain, crf, hmm, langid, nbest, quality
from winnow.llm.shared import crc_mod as crc_column
from winnow.llm.shared import kept, whole_text
from winnow.llm.words import words_of

ROWS = texts() + awkward()
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_chain_agrees_with_a_plain_recursion(monkeypatch):
    rng = np.random.default_rng(1)
    start, move = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3)
    lengths = np.array([1, 9, 4, 30, 2])
    emit = rng.random((lengths.sum(), 3)) + 0.01
    monkeypatch.setattr(chain, "segments", lambda n, cut=chain.segments: cut(n, 4))
    logs, gamma, moves = chain.posterior(emit, lengths, start, move)
    expected = np.zeros((3, 3))
    at = 0
    for n in lengths:
        e = emit[at : at + n]
        a = [start * e[0]]
        for t in range(1, n):
            a.append((a[-1] @ move) * e[t])
        b = [np.ones(3)]
        for t in range(n - 1, 0, -1):
            b.insert(0, move @ (e[t] * b[0]))
        total = a[-1].sum()
        assert logs[at : at + n].sum() == pytest.approx(math.log(total))
        for t in range(n):
            assert gamma[at + t] == pytest.approx(a[t] * b[t] / total)
            if t:
                expected += np.outer(a[t - 1], e[t] * b[t]) * move / total
        at += n
    assert moves == pytest.approx(expected)


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in lower(text).split(" ") if w]


def language_model(spark, rows):
    docs = whole_text(frame(spark, rows)).withColumn("held_out", crc_column("doc_id", 7) == 2)
    counts = kept(hmm.token_counts(docs.where("NOT held_out")), "counts")
    vocab = hmm.vocabulary(counts, share=1 / 400)
    blocks = hmm.token_blocks(docs, vocab)
    model = hmm.train(blocks, vocab, states=3, parts=3)
    return blocks, counts, vocab, model


def test_language_model_counts_and_normalisation(spark):
    blocks, counts, vocab, model = language_model(spark, ROWS)
    found = hmm.score(blocks, counts, vocab, model).collect()
    assert len(found) == len(ROWS)
    seen = Counter()
    for key, text, _ in ROWS:
        if crc_mod(key, 7) != 2:
            seen.update([*words(text), None])
    n, v = sum(seen.values()), len(seen)
    assert (vocab.tokens, vocab.types) == (n, v)
    expected = Counter()
    for key, text, _ in ROWS:
        own = [*words(text), None]
        base = sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in own)
        expected[key, crc_mod(key, 7) == 2, len(own), sum(w in seen for w in own), n, round(base, 6)] += 1
    assert expected == Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found
    )
    # Every state spreads exactly 1 over the known words and the unknown one.
    free = vocab.discount * vocab.class_types / np.maximum(vocab.class_tokens, 1)
    known = 1 - free[vocab.class_tokens > 0]
    used = model.classes[:, vocab.class_tokens > 0]
    assert used.sum(1) == pytest.approx(1)
    assert used @ known + model.classes @ free == pytest.approx(1)
    better = sum(r.score > r.base_score for r in found if r.n_tokens > 20)
    assert better > 0.9 * sum(r.n_tokens > 20 for r in found)


def test_language_model_score_is_the_likelihood_of_the_chain(spark):
    blocks, counts, vocab, model = language_model(spark, ROWS)
    found = {r.doc_id: r.score for r in hmm.score(blocks, counts, vocab, model).collect()}
    counted = {int(r.word): r["count"] for r in counts.collect()}
    for key, text, _ in ROWS[:5]:
        own = words_of(pa.array([text]))
        classes = np.append(vocab.classes_of(own), hmm.END_CLASS)
        c = [counted.get(int(h), 0) for h in own.hash.view(np.int64)] + [counted[int(hmm.END)]]
        alpha, total = model.start, 0.0
        unknown = model.classes @ (vocab.discount * vocab.class_types / np.maximum(vocab.class_tokens, 1))
        for i, (g, n) in enumerate(zip(classes, c)):
            share = (n - vocab.discount) / vocab.class_tokens[g] if n else 0
            e = model.classes[:, g] * share if n else unknown
            alpha = (alpha if i == 0 else alpha @ model.move) * e
            total += math.log10(alpha.sum())
            alpha = alpha / alpha.sum()
        assert found[key] == pytest.approx(total, abs=1e-6)


def test_language_model_without_training_rows(spark):
    docs = whole_text(frame(spark, ROWS[:3])).withColumn("held_out", F.lit(True))
    counts = kept(hmm.token_counts(docs.where("NOT held_out")), "counts")
    vocab = hmm.vocabulary(counts)
    blocks = hmm.token_blocks(docs, vocab)
    model = hmm.train(blocks, vocab)
    found = hmm.score(blocks, counts, vocab, model).collect()
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in found] == [(0, 0, 0.0, 0.0)] * 3
    empty = hmm.token_blocks(docs.limit(0), vocab)
    assert hmm.score(empty, counts, vocab, hmm.train(empty, vocab)).count() == 0


def test_incremental_passes_sum_plain_expected_counts(spark):
    """Expected counts of the parts are those of a plain recursion over their documents, each
    training document lies in one part, and every step raises the likelihood in the end."""
    blocks, counts, vocab, model = language_model(spark, ROWS)
    training = hmm._training_parts(blocks, 3)
    rows = [r for r in training.collect()]
    lengths = sorted(n for r in rows for n in r.lengths)
    assert lengths == sorted(len(words(t)) + 1 for k, t, _ in ROWS if crc_mod(k, 7) != 2)
    found = sum(hmm.expected_counts(training.where(F.col("part") == p), model) for p in range(3))
    expected = np.zeros_like(found)
    for r in rows:
        symbols, at = hmm._from_planes(bytes(r.symbols)), 0
        for n in r.lengths:
            own = symbols[at : at + n]
            a, b = [model.start * model.classes[:, own[0]]], [np.ones(3)]
            for s in own[1:]:
                a.append((a[-1] / a[-1].sum() @ model.move) * model.classes[:, s])
            for s in own[:0:-1]:
                b.insert(0, model.move @ (model.classes[:, s] * b[0] / b[0].sum()))
            for t, s in enumerate(own):
                gamma = a[t] * b[t] / (a[t] * b[t]).sum()
                expected[s] += gamma
                if t == 0:
                    expected[-1] += gamma
                else:
                    pair = np.outer(a[t - 1], model.classes[:, s] * b[t]) * model.move
                    expected[vocab.classes : -1] += pair / pair.sum()
            at += n
    assert found == pytest.approx(expected, rel=1e-3, abs=1e-3)

    def likelihood(passes):
        own = hmm.train(blocks, vocab, states=3, parts=3, passes=passes)
        return hmm.score(blocks, counts, vocab, own).where("NOT held_out").agg(F.sum("score")).head()[0]

    assert likelihood(1) < likelihood(4)


def test_languages_are_told_apart(spark):
    rng = random.Random(8)
    langs = sorted(langid_rows := {"en", "de", "fr"})
    rows = [(i, prose(rng, langs[i % 3], 60), langs[i % 3]) for i in range(90)]
    docs = frame(spark, rows)
    known = langid.learn_dictionaries(docs.where("doc_id < 45"))
    assert set(known) == langid_rows
    assert all(len(d) <= langid.SAMPLE_DOCUMENTS * langid.SAMPLE_BYTES for d in known.values())
    found = langid.identify(docs, known).where("doc_id >= 45").collect()
    right = sum(r.lang_pred == langs[r.doc_id % 3] for r in found)
    assert right >= 0.95 * len(found)
    assert all(0 <= r.score <= 1 and r.margin >= 0 for r in found)


def test_language_of_awkward_texts(spark):
    docs = frame(spark, ROWS)
    known = langid.learn_dictionaries(docs)
    found = langid.identify(docs, known).collect()
    assert len(found) == len(ROWS)
    nothing = {1001, 1002, 1003, 1004}
    for row in found:
        assert (row.lang_pred == "und") == (row.doc_id in nothing)
        assert row.rejected or row.lang_pred in known
    stay = langid.with_language(docs, known)
    assert stay.columns == docs.columns and stay.count() == sum(not r.rejected for r in found)
    assert langid.learn_dictionaries(docs.limit(0)) == {}
    assert {r.lang_pred for r in langid.identify(docs, {}).collect()} == {"und"}
    assert langid.identify(docs.limit(0), known).count() == 0


def toxic_rows():
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(240):
        own = prose(rng, "en", 40).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                own[rng.randrange(len(own))] = rng.choice(["Zargblat", "zargblats,", "zargbling", "quuxfoo"])
        rows.append((i, " ".join(own), "en"))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxic_words_and_documents_are_found(spark):
    rows, labels = toxic_rows()
    docs = frame(spark, rows + awkward())
    known = spark.createDataFrame(labels + [(None, 1), (7, None), (999, 1)], "doc_id long, toxic int")
    train = known.where("doc_id % 3 <> 1 OR doc_id IS NULL")
    sample, flags = crf.labelled_sample(docs, train, "toxic", 100, 100)
    assert len(sample) <= 200 and sum(flags) <= 100
    field = crf.fit(sample, flags)
    found = {r.doc_id: r for r in crf.score(docs, field).collect()}
    held = [(i, y) for i, y in labels if i % 3 == 1]
    assert sum(found[i].predicted == y for i, y in held) >= 0.95 * len(held)
    text = {i: t for i, t, _ in rows}
    hits = [text[i][s.start : s.end].lower() for i, y in held if y for s in found[i].spans]
    assert hits and sum("zargbl" in h or "quuxfoo" in h for h in hits) >= 0.9 * len(hits)
    assert not found[1001].spans and found[1002].predicted == 0
    clean = crf.without_toxic(docs, field)
    assert clean.columns == docs.columns
    assert clean.count() == sum(r.predicted == 0 for r in crf.score(docs, field).collect())
    assert crf.score(docs.limit(0), field).count() == 0


def toxic_texts(rng, number, marks):
    """Clean texts, and toxic ones with three words each that are dealt in turn from ``marks``."""
    clean = [prose(rng, "en", 40) for _ in range(5 * number)]
    toxic = []
    for i in range(number):
        own = prose(rng, "en", 40).split()
        for k in range(3):
            own.insert(rng.randrange(len(own)), marks[(3 * i + k) % len(marks)])
        toxic.append(" ".join(own))
    return clean, toxic


@pytest.mark.parametrize("number, each", [(6, 6), (240, 6)])
def test_toxic_words_in_few_texts_are_learnt(number, each):
    rng = random.Random(21)
    marks = ["".join(rng.choices("bdfgjkmpqvxz", k=8)) for _ in range(3 * number // each)]
    clean, toxic = toxic_texts(rng, number, marks)
    field = crf.fit(clean + toxic, [False] * len(clean) + [True] * len(toxic))
    fresh_clean, fresh_toxic = toxic_texts(rng, number, marks)
    scores = [crf._judged(pa.array(t), field)[2] for t in (fresh_clean, fresh_toxic)]
    assert (scores[1] >= crf.THRESHOLD).mean() >= 0.9
    assert (scores[0] >= crf.THRESHOLD).mean() <= 0.05


def test_toxicity_without_labels_of_both_kinds(spark):
    docs = frame(spark, ROWS)
    for texts_, flags in (([], []), (["a b"], [True]), (["", ""], [True, False])):
        scores = {r.score for r in crf.score(docs, crf.fit(texts_, flags)).collect()}
        assert len(scores) == 1 and 0 < scores.pop() < 1


def test_quality_is_learnt_and_calibrated(spark):
    rng = random.Random(10)
    rows, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        own = prose(rng, "en", 50).split()
        if not good:
            own = [w.upper() + "!!" if i % 2 else w + "###" for w in own]
        rows.append((i, " ".join(own), "en"))
        labels.append((i, int(good)))
    docs = frame(spark, rows + awkward())
    known = spark.createDataFrame(labels + [(None, 1), (7, None)], "doc_id long, quality int")
    vectors = quality.random_indexing(docs)
    net = quality.learn(docs, known.where("doc_id % 4 <> 2"), "quality", vectors)
    found = {r.doc_id: r for r in quality.score(docs, vectors, net).collect()}
    held = [(i, y) for i, y in labels if i % 4 == 2]
    assert sum(found[i].predicted == y for i, y in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())
    assert quality.score(docs.limit(0), vectors, net).count() == 0
    flat = quality.learn(docs, known.limit(0), "quality", vectors)
    assert {r.score for r in quality.score(docs, vectors, flat).collect()} == {0.5}


def plain_vectors(rows, kinds):
    """Sums of the index vectors of the words near every word, text by text, of length 1."""
    place, sign = kinds.index_vectors()
    table = np.zeros((kinds.rows, quality.DIMENSIONS))
    for _, text, _ in rows:
        both = list(zip(*(k.tolist() for k in kinds.of(words_of(pa.array([text or ""]), lower=False)))))
        for i, target in enumerate(both):
            for j in range(max(0, i - quality.NEAR), min(len(both), i + quality.NEAR + 1)):
                for row, context in itertools.product(target, both[j] if j != i else ()):
                    for k in (0, 1):
                        table[row, place[context, k]] += sign[context, k]
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return table / np.where(norm > 0, norm, 1)


def test_contexts_do_not_depend_on_the_words_at_once(monkeypatch):
    kinds = quality.Kinds(np.zeros(0, np.uint64))
    words = words_of(pa.array([t or "" for _, t, _ in ROWS]), lower=False)
    found = []
    for at_once in (50, 77, 1000, 10**6):
        monkeypatch.setattr(quality, "WORDS_AT_ONCE", at_once)
        sums = np.zeros(kinds.rows * quality.DIMENSIONS, np.int64)
        quality.add_contexts(sums, words.doc, kinds.of(words), kinds.index_vectors())
        found.append(sums)
    assert found[0].any() and all((f == found[0]).all() for f in found)


@pytest.mark.parametrize("share", [1e-9, 0.01, 1.0])
def test_context_vectors_follow_the_definition(spark, share):
    rows = ROWS[:30] + awkward()
    vectors = quality.random_indexing(frame(spark, rows), share)
    used = Counter(w for _, t, _ in rows for w in (t or "").encode().split())
    own = words_of(pa.array([w.decode() for w in used]), lower=False).hash
    wanted = [h for h, n in zip(own, used.values()) if n >= share * used.total()]
    assert vectors.kinds.own.tolist() == sorted(int(h) for h in wanted)
    assert np.abs(vectors.table - plain_vectors(rows, vectors.kinds)).max() < 1e-3


def test_quality_scores_agree_with_a_plain_version(spark):
    rows = ROWS[:20] + awkward()
    vectors = quality.random_indexing(frame(spark, rows), 0.01)
    rng = np.random.default_rng(4)
    width, d = 3 * quality.DIMENSIONS + quality.SCALARS, quality.DIMENSIONS
    net = quality.Network(
        np.zeros(width), np.ones(width), rng.normal(0, 1, (width + 1, 4)), rng.normal(0, 1, 5), 1.7
    )
    found = sorted(r.score for r in quality.score(frame(spark, rows), vectors, net).collect())
    expected, table = [], vectors.table.astype(float)
    for _, text, _ in rows:
        words = (text or "").encode().split()
        spelling, shape = vectors.kinds.of(words_of(pa.array([text or ""]), lower=False))
        x, n = np.zeros(width), max(1, len(words))
        if words:
            x[:d], x[d : 2 * d] = table[spelling].mean(0), table[shape].mean(0)
            x[2 * d : 3 * d] = table[shape].std(0)
            x[-5], x[-4] = math.log1p(len(words)), math.log1p(sum(map(len, words)) / n)
            x[-3] = len(set(words)) / n
            x[-2] = sum(a == b for a, b in itertools.pairwise(spelling)) / n
            x[-1] = sum(a == b for a, b in itertools.pairwise(shape)) / n
        x = np.clip(x, -8, 8)
        out = np.tanh(x @ net.first[:-1] + net.first[-1]) @ net.second[:-1] + net.second[-1]
        expected.append(1 / (1 + math.exp(-out / 1.7)))
    assert found == pytest.approx(sorted(expected), abs=1e-3)


def every_way(own: nbest.Segmenter, text: str):
    found = []

    def go(at, score, ids):
        if at == len(text):
            found.append((score, ids))
            return
        alone = False
        for end in range(at + 1, len(text) + 1):
            piece = own.scores.get(text[at:end])
            if piece:
                alone |= end == at + 1
                go(end, score + piece[1], ids + (piece[0],))
        if not alone:
            go(at + 1, score + own.unknown, ids + tuple(own.bytes_of[b] for b in text[at].encode()))

    go(0, 0.0, ())
    return sorted(found, key=lambda f: -f[0])


@pytest.mark.parametrize("best", [1, 3, 7])
def test_best_segmentations_agree_with_all_of_them(best):
    own = nbest.Segmenter(PIECES, best)
    for text in ("hello the", "a  b\nc", "é😀 x", "  x", "\n\n", "unter, ab", "▁a"):
        expected = every_way(own, "▁" + text.replace(" ", "▁"))
        found = next(own.texts([text]))
        assert [s for s, _ in found] == pytest.approx([s for s, _ in expected[:best]])
        by_ids = {ids: s for s, ids in expected}
        coded = [tuple(np.frombuffer(ids, "<i4").tolist()) for _, ids in found]
        assert len(set(coded)) == len(coded)
        assert all(by_ids[ids] == pytest.approx(s) for ids, (s, _) in zip(coded, found))


def test_units_of_any_length_are_searched():
    rng = random.Random(12)
    own = nbest.Segmenter(PIECES, 4)
    unspaced = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/", k=100_000))
    for text in (unspaced, "中文字" * 30_000, "-" * 398, "-" * 1_000):
        ways = next(own.texts([text]))
        assert [s for s, _ in ways] == sorted((s for s, _ in ways), reverse=True)
        assert len({ids for _, ids in ways}) == len(ways)
        assert all(own.decode(ids) == text for _, ids in ways)
    # A long unit's ways are not kept.
    assert all(len(unit) <= nbest.LONGEST_KEPT for unit in [*own.known, *own.lists])


def test_round_trip_sees_every_wrong_way():
    own = nbest.Segmenter(PIECES, 4)
    ways = next(own.texts(["under the table and out again"]))
    assert own.round_trip("under the table and out again", ways)
    assert not own.round_trip("under the table and out", ways)
    for k in range(1, 4):
        ids = np.frombuffer(ways[k][1], "<i4")
        for at in range(len(ids)):
            wrong = np.concatenate([ids[:at], ids[at + 1 :]]).astype("<i4").tobytes()
            bad = [*ways[:k], (0.0, wrong), *ways[k + 1 :]]
            assert not own.round_trip("under the table and out again", bad)
            longer = np.concatenate([ids[:at], ids[at : at + 1], ids[at:]]).astype("<i4").tobytes()
            assert not own.round_trip("under the table and out again", [*ways[:k], (0.0, longer)])


def test_search_opens_places_of_results_only():
    own = nbest.Segmenter(PIECES, 4)
    text = "▁" + "notwithstanding" * 20
    top = own.forward(text)
    assert own.nbest(text, 1)[0][0] == pytest.approx(top[len(text)])
    every = own.nbest(text, 4)
    assert [s for s, _ in every] == sorted((s for s, _ in every), reverse=True)
    assert own.nbest("", 3) == [(0.0, b"")]


def test_segmentations_decode_to_their_texts(spark):
    docs = frame(spark, ROWS)
    ways = kept(nbest.segmentations(docs, PIECES, 3), "ways")
    assert ways.where("rank = 1").count() == len(ROWS)
    text = Counter((i, t or "") for i, t, _ in ROWS)
    spelled = nbest.decoded(ways.where("rank = 1"), PIECES).collect()
    assert Counter((r.doc_id, r.text) for r in spelled) == text
    digests = nbest.digests(docs, PIECES, 3).collect()
    assert all(r.round_trip for r in digests) and len(digests) == len(ROWS)
    by_rank = Counter((r.doc_id, r.rank, len(r.ids), round(r.score, 6)) for r in ways.collect())
    flat = itertools.chain.from_iterable(
        ((r.doc_id, k, n, round(s, 6)) for k, (n, s) in enumerate(zip(r.n_pieces, r.scores), 1)) for r in digests
    )
    assert Counter(flat) == by_rank
    assert nbest.digests(docs.limit(0), PIECES).count() == 0
