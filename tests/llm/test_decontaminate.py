from __future__ import annotations

import random

import numpy as np
from llm_helpers import docs, odd_texts, words

from cardsentry.llm import decontaminate as D


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_bit_parallel_lcs():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 6, rng.integers(0, 70)), rng.integers(0, 6, rng.integers(0, 70))
        assert D.lcs(a, b) == lcs(a.tolist(), b.tolist())


def test_gram_sketch_and_nystroem_give_the_singular_vectors():
    rng = np.random.default_rng(2)
    t = rng.integers(0, 40, 3200)
    starts = np.arange(0, 3200, 32)
    idf = rng.uniform(0.5, 2, D.TERMS).astype(np.float32)
    omega = D.gaussian()
    total = np.zeros((D.TERMS, D.RANK + D.EXTRA), np.float32)
    D.gram_sketch(t, starts, idf, omega * idf[:, None], total)
    total *= idf[:, None]
    a = np.zeros((100, D.TERMS))
    for p in range(100):
        np.add.at(a[p], t[32 * p : 32 * p + 32], idf[t[32 * p : 32 * p + 32]])
    rows = np.sqrt(np.add.reduceat(idf[t] ** 2, starts))
    a /= rows[:, None]
    assert np.allclose(total, a.T @ (a @ omega), atol=1e-2)
    _, sigma = D.nystroem(total.astype(float), omega.astype(float))
    assert np.allclose(sigma[:16], np.linalg.svd(a[:, :40], compute_uv=False)[:16], rtol=0.03, atol=0.08)


def test_frequencies_and_stop_words():
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 50, n).astype(np.uint32) for n in (1, 31, 32, 33, 200)]
    df = np.zeros(D.TERMS)
    n = D.frequencies(docs, df)
    want = np.zeros(D.TERMS)
    parts = [d[k : k + D.PASSAGE] for d in docs for k in range(0, len(d), D.PASSAGE)]
    for p in parts:
        want[np.unique(p)] += 1
    assert n == len(parts) and np.array_equal(df, want)
    df = np.array([90.0, 50, 30, 1, 1, 1] + [1] * 200)
    w = D.weights(df, 100)
    assert w[0] == 0 and (w[3:] > 0).all()


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = words(rng, 600)
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(k, text(rng.randint(20, 50)) + ". " + text(6).capitalize() + ".") for k in range(12)] + [(90, None), (91, ""), (92, "two words")]
    rows = [(k, text(rng.randint(1, 300))) for k in range(150)]
    leaks = set()
    for k, (i, t) in enumerate(items[:12]):
        rows.append((500 + k, text(40) + "\n" + t + "\n" + text(60)))
        leaks.add((500 + k, i))
        w = t.upper().split()
        for p in rng.sample(range(len(w) - 6), max(1, len(w) // 10)):  # a paraphrase that keeps the answer
            w[p] = "changed"
        rows.append((600 + k, text(30) + " " + " ".join(w) + " " + text(30)))
        leaks.add((600 + k, i))
    rows.append((700, text(70_000) + " " + items[3][1] + " " + text(10)))
    leaks.add((700, 3))
    return rows, items, leaks


def test_leaks_and_paraphrases_are_found_and_clean_documents_left(spark):
    rows, items, want = corpus()
    rows += [(800 + k, t) for k, t in enumerate(odd_texts())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.leaks(spark, docs(spark, rows), bench).collect() if r["item_id"] != 92}
    assert got == want
    frame = docs(spark, rows + [rows[-1], (None, items[0][1]), (None, "clean")])
    kept = D.decontaminated(spark, frame, bench.where("item_id <> 92"))
    assert kept.columns == frame.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    dirty = {i for i, _ in want}
    assert sorted(map(str, left)) == sorted(map(str, [r for r in rows + [rows[-1], (None, "clean")] if r[0] not in dirty]))


def test_items_are_searched_in_blocks(spark, monkeypatch):
    rows, items, want = corpus(5)
    monkeypatch.setattr(D, "ITEM_BLOCK", 5)
    bench = spark.createDataFrame(items[:12], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in D.leaks(spark, docs(spark, rows), bench).collect()} == want


def searched(docs, items, idf, latent):
    """Leaks of word arrays, without Spark."""
    return D.search(docs, idf, latent, D.query_of([D.Item(k, w, w[-6:]) for k, w in enumerate(items)], idf, latent))


def random_model(seed=1):
    """Terms below 2,000 are stop words; the others have random vectors."""
    rng = np.random.default_rng(seed)
    idf = np.ones(D.TERMS)
    idf[:2000] = 0
    latent = (rng.standard_normal((D.TERMS, D.RANK)) * (idf > 0)[:, None]).astype(np.float32)
    return rng, idf, latent


def test_item_far_from_its_windows_first_word_is_found():
    """Stop words stretch a window over many more words than the margin."""
    rng, idf, latent = random_model()
    item = np.concatenate([rng.integers(2000, 16000, 9), rng.integers(0, 2000, 6)]).astype(np.uint32)
    for lead in range(0, 12):
        foreign = rng.integers(2000, 16000, lead).astype(np.uint32)
        before = np.stack([foreign, *rng.integers(0, 2000, (3, lead)).astype(np.uint32)], 1).ravel()
        doc = np.concatenate([before, item, rng.integers(0, 2000, 60).astype(np.uint32)])
        assert (0, 0) in searched([doc], [item], idf, latent), lead


def test_verbatim_items_are_found_whatever_their_cosine():
    """Verbatim and lightly changed items whose windows point elsewhere; recall against the LCS alone."""
    rng, idf, latent = random_model(2)
    latent[:] = 0  # no cosine reaches the limit
    items = [rng.integers(0, 16000, n).astype(np.uint32) for n in (8, 10, 14, 20, 40, 60)]
    docs, want = [], set()
    for k, item in enumerate(items):
        for change in (0, len(item) // 10, len(item) // 5):
            w = item.copy()
            w[rng.choice(len(w) - 3, change, False)] = 15_000_000
            want.add((len(docs), k))
            docs.append(np.concatenate([rng.integers(20000, 40000, int(rng.integers(0, 90))).astype(np.uint32), w, rng.integers(20000, 40000, 40).astype(np.uint32)]))
        docs.append(rng.integers(20000, 40000, 200).astype(np.uint32))
    got = searched(docs, items, idf, latent)
    brute = {(n, k) for n, d in enumerate(docs) for k, i in enumerate(items) if D.lcs(i, d) >= D.STRONG * len(i)}
    assert want == brute and set(got) == want


def test_a_run_of_words_does_not_reach_into_the_next_document():
    rng, idf, latent = random_model(3)
    item = rng.integers(2000, 16000, 20).astype(np.uint32)
    assert searched([item[:8], item[8:15], item[15:]], [item], idf, latent) == {}


def test_near_copies_of_an_item_that_became_stop_words_are_found():
    """An item in a third of the documents has no content words left; one changed word must not hide it."""
    rng, _, _ = random_model(4)
    item, clean = rng.integers(2000, 16000, 59).astype(np.uint32), lambda n: rng.integers(16000, 400000, n).astype(np.uint32)
    docs = [np.concatenate([clean(25), item, clean(20)]) if k % 3 == 0 else clean(100) for k in range(90)]
    near = []
    for change in (1, 6, 12):
        w = item.copy()
        w[rng.choice(59, change, False)] = 15_000_000
        near.append(np.concatenate([clean(30), w, clean(30)]))
    df = np.zeros(D.TERMS)
    idf = D.weights(df, D.frequencies(docs, df))
    assert len(D.content_of(item, idf)) < D.FEW
    latent = (rng.standard_normal((D.TERMS, D.RANK)) * (idf > 0)[:, None]).astype(np.float32)
    assert set(searched(docs + near, [item], idf, latent)) == {(k, 0) for k in [*range(0, 90, 3), 90, 91, 92]}


def test_long_item_across_the_end_of_a_stretch_is_found():
    rng, idf, latent = random_model(5)
    item = rng.integers(0, 16000, 4000).astype(np.uint32)
    clean = lambda n: rng.integers(20000, 400000, n).astype(np.uint32)
    held = item.copy()
    held[-6:] = 15_000_000  # without its answer 70 % must be there
    doc = np.concatenate([clean(D.STRETCH + D.OVERLAP // 2 - 2000), held, clean(5000)])
    assert set(searched([doc], [item], idf, latent)) == {(0, 0)}


def test_a_long_document_is_searched_in_bounded_products(monkeypatch):
    rng, idf, latent = random_model(6)
    items = [rng.integers(2000, 16000, 30).astype(np.uint32) for _ in range(4)]
    doc = np.concatenate([x for i in items for x in (rng.integers(2000, 16000, 5000).astype(np.uint32), i)])
    want = searched([doc], items, idf, latent)
    monkeypatch.setattr(D, "PRODUCT", 64)
    got = searched([doc], items, idf, latent)
    assert set(got) == set(want) == {(0, k) for k in range(4)}
    for k, v in want.items():
        assert np.allclose(np.array(got[k], float), np.array(v, float), atol=1e-5)


def test_long_items_are_searched_in_bounded_products(monkeypatch):
    """Items of 1,000 words: no product has more than PRODUCT windows on a side, and the results stay."""
    rng, idf, latent = random_model(7)
    items = [rng.integers(0, 16000, 1000).astype(np.uint32) for _ in range(40)]
    clean = lambda n: rng.integers(20000, 400000, n).astype(np.uint32)
    docs = [np.concatenate([clean(300), items[k], clean(300)]) for k in (0, 17, 39)] + [clean(2000)]
    query = D.query_of([D.Item(k, w, w[-6:]) for k, w in enumerate(items)], idf, latent)
    want = D.search(docs, idf, latent, query)
    assert {k for k in want} == {(0, 0), (1, 17), (2, 39)}
    sizes, real = [], np.nonzero

    def nonzero(x):
        if x.ndim == 2:
            sizes.append(x.shape)
        return real(x)

    monkeypatch.setattr(D, "PRODUCT", 256)
    monkeypatch.setattr(D.np, "nonzero", nonzero)
    got = D.search(docs, idf, latent, query)
    assert len(query.vec) > 10_000 and sizes and max(max(s) for s in sizes) <= 256
    assert set(got) == set(want) and all(got[k][2:] == want[k][2:] for k in want)


def test_item_blocks_are_bounded_by_words(spark, monkeypatch):
    rows, items, want = corpus(8)
    seen, real = [], D.query_of
    monkeypatch.setattr(D, "ITEM_WORDS", 100)
    monkeypatch.setattr(D, "query_of", lambda block, *a: seen.append(sum(len(i.words) for i in block)) or real(block, *a))
    bench = spark.createDataFrame(items[:12], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in D.leaks(spark, docs(spark, rows), bench).collect()} == want
    assert len(seen) > 3 and max(seen) <= 100


def test_short_items_equal_brute_force_and_need_one_look_up_a_length(monkeypatch):
    rng, idf, latent = random_model(9)
    items = [rng.integers(0, 30, int(n)).astype(np.uint32) for n in rng.integers(1, D.SHORT, 2000)]
    docs = [rng.integers(0, 30, int(n)).astype(np.uint32) for n in rng.integers(0, 60, 40)]
    held = lambda d, i: next((a for a in range(len(d) - len(i) + 1) if np.array_equal(d[a : a + len(i)], i)), None)
    want = {(n, k): a for n, d in enumerate(docs) for k, i in enumerate(items) if (a := held(d, i)) is not None}
    calls, real = [], D.gram_places
    monkeypatch.setattr(D, "gram_places", lambda *a: calls.append(1) or real(*a))
    got = searched(docs, items, idf, latent)
    assert {k: v[0] for k, v in got.items()} == want and len(want) > 1000
    assert len(calls) == D.SHORT - 1  # one for each length, however many items there are


def test_a_paraphrase_that_only_the_latent_path_finds():
    """Every third word of the item is another one: no run of three words is left, the windows still point its way."""
    rng, idf, latent = random_model(10)
    item = rng.integers(2000, 16000, 48).astype(np.uint32)
    clean = lambda n: rng.integers(20000, 400000, n).astype(np.uint32)
    held = item.copy()
    held[2:-6:3] = clean(len(held[2:-6:3]))
    doc = np.concatenate([clean(50), held[:-6], clean(3), item[-6:-3], clean(1), item[-3:], clean(50)])
    held_grams = D.gram_keys(doc, D.GRAM)
    answer_less = np.isin(held_grams, D.gram_keys(item[:-6], D.GRAM))
    assert not answer_less.any()
    query = D.query_of([D.Item(0, item, item[-6:])], idf, latent)
    query.grams = []  # the exact index is off
    assert set(D.search([doc, clean(300)], idf, latent, query)) == {(0, 0)}
    query.vec = query.vec[:0]  # and now the latent path too
    assert D.search([doc], idf, latent, query) == {}


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "some benchmark text of nine words in all here")], "item_id long, text string")
    assert D.leaks(spark, docs(spark, []), bench).collect() == []
    assert D.leaks(spark, docs(spark, [(1, "x")]), bench.where("false")).collect() == []
    assert D.decontaminated(spark, docs(spark, [(1, "x"), (2, None)]), bench.where("false")).count() == 2
