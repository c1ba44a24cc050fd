from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from samples import awkward, frame, texts
from winnow.llm import reversed_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS = texts() + awkward() + [(2000 + i, "A BÀc, the.the_And it's 你好 x9", "en") for i in range(30)]


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, top=20):
    """The contract, document by document."""
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, all_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked: dict = {}
    for key, text in items:
        asked.setdefault(key, []).extend(terms(text))
    out = []
    for key, words in asked.items():
        scored = []
        for doc, bag in bags:
            n = sum(bag.values())
            m = 75 + (25 * n * n_docs) // all_terms
            score = 0
            for t in words:
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [
            (key, r, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(scored)[:top], 1)
        ]
    return sorted(out, key=str)


def search(spark, docs, items, **options):
    benchmark = spark.createDataFrame(
        [(k, t, "d", 1, 2) for k, t in items], "item_id long, text string, doc_id string, score int, rank int"
    )
    found = reversed_search.search(frame(spark, docs), benchmark, **options).collect()
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in found), key=str)


def items():
    rng = random.Random(3)
    words = [w for _, t, _ in ROWS if t for w in t.split()]
    many = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(25)]
    many += [(25, None), (26, ""), (27, "?!"), (28, "nowhere-found"), (29, "the the THE the"), (None, "and key")]
    return many + [(3, "same words"), (30, "bàc 你好"), (31, "bÀc 你好")]


@pytest.mark.parametrize("block_bytes", [reversed_search.BLOCK_BYTES, 1500])
def test_ranks_agree_with_brute_force(spark, block_bytes):
    docs = [(i, t) for i, t, _ in ROWS]
    assert search(spark, ROWS, items(), block_bytes=block_bytes) == ranked(docs, items())


def test_one_best_document_and_no_documents(spark, monkeypatch):
    docs = [(i, t) for i, t, _ in ROWS]
    assert search(spark, ROWS, items(), top=1) == ranked(docs, items(), top=1)
    assert search(spark, [], items()) == []
    assert search(spark, ROWS, []) == []
    assert search(spark, [(1, None, None), (2, "..", None)], items()) == []


def test_heaps_keep_the_best_in_any_order_of_arrival():
    rng = np.random.default_rng(5)
    scores = rng.integers(0, 6, (300, 4))
    keys, null = rng.permutation(300), rng.random(300) < 0.1
    heaps = reversed_search.Heaps(4, 7)
    for low in range(0, 300, 11):
        heaps.offer(scores[low : low + 11], keys[low : low + 11], null[low : low + 11])
    mine = sorted(zip(*heaps.rows()), key=str)
    want = []
    for item in range(4):
        order = sorted((-s, n, k) for s, n, k in zip(scores[:, item].tolist(), null.tolist(), keys.tolist()) if s)
        want += [(item, s) for s, _, _ in order[:7]]
    assert sorted((i, -s) for i, _, s in mine) == sorted(want)
    kept = {(i, d) for i, d, _ in mine if d is not None}
    for item in range(4):
        order = sorted((-s, n, k) for s, n, k in zip(scores[:, item].tolist(), null.tolist(), keys.tolist()) if s)
        assert kept >= {(item, k) for _, n, k in order[:7] if not n}
