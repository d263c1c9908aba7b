from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from llm_helpers import docs, odd_texts, words

from cardsentry.llm import lexical_rank as lr

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, k=10):
    """One scored list an item row, by the formula."""
    tfs = [(i, Counter(terms(t))) for i, t in rows]
    tfs = [(i, tf) for i, tf in tfs if tf]
    n_docs, n_terms = len(tfs), sum(sum(tf.values()) for _, tf in tfs)
    df = Counter(t for _, tf in tfs for t in tf)
    out = []
    for item, text in items:
        scored = []
        for doc, tf in tfs:
            m = 100 - 90 + 90 * sum(tf.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                for t in set(terms(text)) if t in tf
            )
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def corpus(rng, n=120):
    pool = words(rng, 60) + ["Éa", "日本", "x1", "ẞ", "don't", "a-b"]
    rows = [(k, " ".join(rng.choice(pool) for _ in range(rng.randint(1, 40)))) for k in rng.sample(range(1000), n)]
    rows += [(2000 + k, rows[0][1].upper()) for k in range(25)]  # ties beyond the tenth place
    rows += [(5000 + k, t) for k, t in enumerate(odd_texts())] + [(None, rows[0][1]), rows[0], (7000, "word " * 30_000)]
    return rows, [(k, " ".join(rng.choice(pool) for _ in range(rng.randint(1, 15)))) for k in range(30)]


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 1.0, 2) for i, t in items], "item_id long, text string, score double, rank int")


def collected(spark, rows, items, k=10, parts=5):
    got = lr.ranked(spark, docs(spark, rows).repartition(parts), items_frame(spark, items), k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got.collect()), key=str)


def test_ranks_equal_brute_force(spark):
    rows, items = corpus(random.Random(1))
    items += [(40, rows[0][1]), (41, None), (42, ""), (43, "never seen termsss"), (None, rows[1][1])]
    assert collected(spark, rows, items) == brute(rows, items)
    assert collected(spark, rows, items, k=3, parts=1) == brute(rows, items, k=3)


def test_many_small_tiles_and_blocks_give_the_same(spark, monkeypatch):
    rows, items = corpus(random.Random(2), 60)
    monkeypatch.setattr(lr, "CELLS", 64)
    monkeypatch.setattr(lr, "TILES", 3)
    assert len(list(lr.item_blocks((i, t.encode()) for i, t in items))) > 1
    assert collected(spark, rows, items) == brute(rows, items)


def test_repeated_items_are_ranked_by_themselves(spark):
    rows, items = corpus(random.Random(3), 40)
    assert collected(spark, rows, items[:2] + items[:1]) == brute(rows, items[:2] + items[:1])


def test_products_stay_exact_in_groups():
    rng = np.random.default_rng(0)
    impact = rng.integers(0, lr.MOST_IMPACT, (7, 30)).astype(float)
    tile = lr.Tile(0, columns=np.arange(5, 30), weights=rng.integers(0, 28_000, (25, 4)).astype(float))
    want = impact[:, 5:30].astype(np.int64) @ tile.weights.astype(np.int64)
    for exact in (lr.EXACT, 10**11, 1):
        assert (lr.product(impact, tile, exact) == want).all()


def test_empty_tables(spark):
    rows, items = corpus(random.Random(4), 10)
    none = docs(spark, rows).limit(0)
    assert lr.ranked(spark, none, items_frame(spark, items)).collect() == []
    assert lr.ranked(spark, docs(spark, rows), items_frame(spark, items).limit(0)).collect() == []
    assert lr.ranked(spark, docs(spark, [(1, None), (2, "")]), items_frame(spark, items)).collect() == []


def test_terms():
    assert lr.terms_of("A-Z İSTANBUL, ß42's\x7f~é x".encode()) == [t.encode() for t in terms("A-Z İSTANBUL, ß42's\x7f~é x")]
