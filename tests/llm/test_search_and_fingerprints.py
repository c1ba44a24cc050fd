from __future__ import annotations

import hashlib
import random

import numpy as np
from samples import awkward, frame, texts
from winnow.llm import topk, winnowing

ROWS = texts() + awkward()


def brute(vectors, every, top):
    whole = [
        (i, np.floor(256 * np.array(v, float)))
        for i, v in vectors
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for q, a in whole:
        if q % every == 0:
            n = [(int(-sum(x * y for x, y in zip(a, b))), i) for i, b in whole if i != q]
            out += [(q, r, i, min(2**63 - 1, max(-(2**63), -s))) for r, (s, i) in enumerate(sorted(n)[:top], 1)]
    return sorted(out)


def search(spark, vectors, **options):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    found = topk.top_of(df, "vec_id", "embedding", **options).collect()
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found)


def test_search_agrees_with_brute_force(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.2, 24).astype(np.float32)]) for i in range(300)]
    vectors += [(1000 + i, vectors[7][1]) for i in range(9)]  # ties
    vectors += [(2000, None), (2050, [None] * 24), (2100, [float("nan")] * 24), (2150, [float("inf")] * 24)]
    vectors += [(2200, [0.5, 0.25]), (2250, []), (None, [0.1] * 24)]
    for groups in (8192, 60):
        found = search(spark, vectors, group_candidates=groups, group_queries=4 if groups == 60 else 16384)
        assert found == brute(vectors, 50, 5)


def test_search_with_large_components_and_few_vectors(spark):
    vectors = [(0, [1e12, -3.0]), (50, [2e12, 1.0]), (3, [-1e12, 4.0])]
    assert search(spark, vectors) == brute(vectors, 50, 5)
    assert search(spark, [(0, [1.0])]) == []
    assert search(spark, []) == []


def test_coarse_bounds_hold():
    rng = np.random.default_rng(5)
    q, x = rng.integers(-200, 200, (20, 30)).astype(float), rng.integers(-200, 200, (50, 30)).astype(float)
    for count in (1, 4, 7, 30, 64):
        bound = topk.segment_features(q, count) @ topk.segment_features(x, count).T
        assert (bound >= q @ x.T - 1e-6).all()


def windows(hashes, window):
    """Positions chosen by the definition: smallest hash of each window, rightmost of equal ones."""
    n = max(1, len(hashes) - window + 1)
    chosen = set()
    for low in range(n):
        own = range(low, min(low + window, len(hashes)))
        least = min(hashes[i] for i in own)
        chosen.add(max(i for i in own if hashes[i] == least))
    return chosen


def test_fingerprints_follow_the_definition(spark):
    for gram, window in ((3, 8), (2, 5), (1, 1)):
        df = winnowing.with_fingerprint(frame(spark, ROWS), "text", "x_", gram, window)
        every = winnowing.with_fingerprint(frame(spark, ROWS), "text", "x_", gram, 1)
        for row, all_grams in zip(df.collect(), every.collect()):
            hashes = [int(h.split(":")[1], 16) for h in all_grams.x_fingerprint.split()]
            places = [int(h.split(":")[0]) for h in all_grams.x_fingerprint.split()]
            assert places == list(range(len(places)))
            found = {int(h.split(":")[0]): int(h.split(":")[1], 16) for h in row.x_fingerprint.split()}
            assert set(found) == windows(hashes, window)
            assert all(hashes[i] == h for i, h in found.items())
            assert set(row.x_hashes) == set(found.values())


def test_equal_grams_have_equal_hashes_anywhere(spark):
    rows = [(1, "a b c d e", "en"), (2, "x y a b c d e", "en")]
    found = winnowing.with_fingerprint(frame(spark, rows), "text", "", 3, 1).collect()
    first, second = ([h.split(":")[1] for h in r.fingerprint.split()] for r in found)
    assert first == second[2:]


def edited(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for i, (key, text, _) in enumerate(order):
        following = order[(i + 1) % len(order)][1] or ""
        text = text or ""
        cut = len(text) // 3
        new = text[: len(text) - cut] + following[:cut]
        out[key] = (len(text), hashlib.sha256(new.encode()).hexdigest(), new, following)
    return out


def test_edited_texts_take_from_the_next_document(spark):
    rows = [r for r in ROWS if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    expected = edited(rows)
    for parts in (1, 4, 500):
        found = winnowing.edited_fingerprints(frame(spark, rows), parts=parts).collect()
        assert len(found) == len(rows)
        for row in found:
            assert (row.n_chars, row.edited_sha256) == expected[row.doc_id][:2], row.doc_id
            assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    by_text: dict = {}
    for row in found:
        text = dict((r[0], r[1] or "") for r in rows)[row.doc_id]
        assert by_text.setdefault(text, row.fingerprint) == row.fingerprint
        assert by_text.setdefault(expected[row.doc_id][2], row.edited_fingerprint) == row.edited_fingerprint


def test_repeated_null_and_single_keys(spark):
    found = winnowing.edited_fingerprints(frame(spark, ROWS)).collect()
    assert len(found) == len(ROWS)
    alone = winnowing.edited_fingerprints(frame(spark, [(5, "abc def", "en")])).collect()
    assert alone[0].edited_sha256 == hashlib.sha256(b"abc dab").hexdigest()
    unkeyed = winnowing.edited_fingerprints(frame(spark, [(None, "abc", "en")] * 2)).collect()
    assert len(unkeyed) == 2
    # Without any key the last text is followed by the first, so each takes from the other.
    pair = winnowing.edited_fingerprints(frame(spark, [(None, "abcdef", "en"), (None, "uvwxyz", "en")]))
    expected = {hashlib.sha256(t).hexdigest() for t in (b"abcduv", b"uvwxab")}
    assert {r.edited_sha256 for r in pair.collect()} == expected
    assert winnowing.edited_fingerprints(frame(spark, [])).count() == 0


def test_short_and_unspaced_texts_keep_hashes_when_edited(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(["harbour", "quiet", "of", "lamp", "seventy", "green"], k=10)), "en")
            for i in range(30)]
    rows += [(100 + i, "".join(chr(0x4E00 + rng.randrange(4000)) for _ in range(96)), None) for i in range(5)]
    for row in winnowing.edited_fingerprints(frame(spark, rows)).collect():
        assert row.near_edited > 0, row.doc_id


def test_units_are_pieces_of_words_and_single_characters(spark):
    text = "abcdefg hi\u4e2d\u6587 \u00e9!\U00020001z"
    expected = ["abc", "def", "g", "hi", "\u4e2d", "\u6587", "\u00e9!", "\U00020001", "z"]
    df = winnowing.with_fingerprint(frame(spark, [(1, text, "en")]), "text", "", 1, 1)
    values = spark.createDataFrame([(u,) for u in expected], "u string")
    hashes = [r[0] for r in values.selectExpr("lower(hex(pmod(xxhash64(u), 2147483647)))").collect()]
    assert [h.split(":")[1] for h in df.head().fingerprint.split()] == hashes
