from __future__ import annotations

import random

import numpy as np
import pytest
from llm_helpers import docs, odd_texts, words

from cardsentry.llm import jaccard_join as J
from cardsentry.llm.components import components
from cardsentry.llm.shingles import jaccard, shingle_set, word_hashes


def shingles(t):
    w = (t or "").lower().split()
    n = min(5, len(w))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def classes(rows, limit=0.8):
    ids = sorted({i for i, _ in rows})
    parent, sets = {i: i for i in ids}, [(i, shingles(t)) for i, t in rows]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            if a and b and len(a & b) / len(a | b) >= limit:
                x, y = find(parent, i), find(parent, j)
                parent[max(x, y)] = min(x, y)
    return {i: find(parent, i) for i in ids}


def corpus(seed, families=12, copies=6, hot=0):
    rng = random.Random(seed)
    rows, line = [], " ".join(words(rng, 30))
    for f in range(families):
        base = words(rng, rng.randint(30, 120))
        for c in range(copies if f or not hot else hot):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = words(rng, 1)[0]
            rows.append((len(rows), " ".join(w) + (f" {line}" if rng.random() < 0.3 else "")))
    rng.shuffle(rows)
    return rows


def test_shingle_sets_match_plain_python():
    rng = random.Random(1)
    texts = [t for t in odd_texts() if t] + [" ".join(words(rng, 50)) for _ in range(5)]
    for t in texts:
        ascii_words = [w for w in t.lower().replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if w]
        assert len(word_hashes(t)) == len(ascii_words)
    a, b = " ".join(words(rng, 80)), " ".join(words(rng, 40))
    both = a + " " + b
    x, y = shingles(a), shingles(both)
    assert jaccard(shingle_set(word_hashes(a)), shingle_set(word_hashes(both))) == pytest.approx(len(x & y) / len(x | y))


@pytest.mark.parametrize(("limit", "depth"), [(400, 4), (4, 2)])
def test_classes_equal_brute_force(spark, limit, depth):
    """Also with buckets so small that splitting, leaders and blocks all run."""
    rows = corpus(3, hot=25)
    members, links = J.near_duplicates(spark, docs(spark, rows), limit=limit, depth=depth)
    got = {r["doc_id"]: r["class_id"] for r in members.collect()}
    assert got == classes(rows)
    text = dict(rows)
    for r in links.collect():
        a, b = shingles(text[r["a"]]), shingles(text[r["b"]])
        assert r["similarity"] == pytest.approx(len(a & b) / len(a | b)) and r["similarity"] >= 0.8


def test_shuffle_join_path_gives_the_same(spark):
    rows = corpus(5, families=5)
    members, _ = J.near_duplicates(spark, docs(spark, rows), broadcast_rows=0)
    assert {r["doc_id"]: r["class_id"] for r in members.collect()} == classes(rows)


def degrees(rows, limit=0.8):
    """Links of each row's text to the other texts, by brute force."""
    text = {i: " ".join((t or "").lower().split()) for i, t in rows}
    sets = {t: shingles(t) for t in text.values() if t}
    n = {t: sum(1 for u in sets if u != t and len(sets[t] & sets[u]) / len(sets[t] | sets[u]) >= limit) for t in sets}
    return {i: n.get(t, 0) for i, t in text.items()}


@pytest.mark.parametrize(("block", "chars"), [(1000, 1 << 23), (7, 1 << 23), (1000, 3000)])
def test_link_counts_equal_brute_force_in_a_large_group(spark, block, chars):
    """50 edited copies of one text, whole or by blocks, beside small families and odd rows."""
    rng = random.Random(11)
    base = words(rng, 120)
    rows = []
    for k in range(50):
        w = list(base)
        for _ in range(k % 5):
            w[rng.randrange(len(w))] = words(rng, 1)[0]
        rows.append((1000 + k, " ".join([*w, f"copy{k}"])))
    rows += corpus(12, families=4) + [(3000, None), (3001, ""), (3002, "one two")]
    want = degrees(rows)
    assert max(want.values()) > 20 and len(set(want.values())) > 5
    got = {r["doc_id"]: r["n_links"] for r in J.counted(spark, docs(spark, rows), block=block, block_chars=chars).collect()}
    assert got == want


def test_cell_links_with_rare_and_common_shingles(monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(J, "COLUMNS", 7)
    for n in (2, 5, 60):
        base = np.arange(40, dtype=np.uint64)
        sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(30, 41), False), rng.integers(100, 130, 3).astype(np.uint64)])) for _ in range(n)]
        sides = np.arange(n) % 2
        near = np.array([[i != j and jaccard(a, b) >= 0.6 for j, b in enumerate(sets)] for i, a in enumerate(sets)])
        assert J.cell_links(sets, sides, False, 0.6).tolist() == near.sum(axis=1).tolist()
        assert J.cell_links(sets, sides, True, 0.6).tolist() == (near & (sides[:, None] != sides)).sum(axis=1).tolist()


def test_odd_rows(spark):
    rng = random.Random(9)
    long = " ".join(words(rng, 30_000))
    rows = [(k, t) for k, t in enumerate(odd_texts())]
    rows += [(50, "one two three"), (51, "ONE two  three"), (52, "one two three four"), (60, long), (61, long + " end"), (70, "same"), (70, "same"), (None, "same")]
    got = {}  # ids repeat here, so classes are named by hashes
    for r in J.near_duplicates(spark, docs(spark, rows))[0].collect():
        got.setdefault(r["doc_id"], []).append(r["class_id"])
    assert sum(map(len, got.values())) == len(rows)
    assert len({got[k][0] for k in range(4)}) == 4  # no words: never linked
    assert got[50] == got[51] != got[52]
    assert got[60] == got[61]
    assert got[70] == got[None] * 2
    assert len({c for k in got for c in got[k]}) == len(rows) - 1 - 1 - 2


def test_classes_are_named_by_the_smallest_id_where_ids_are_unique(spark):
    rows = [(k, t) for k, t in enumerate(odd_texts())] + [(50, "one two three"), (51, "ONE two  three")]
    got = {r["doc_id"]: r["class_id"] for r in J.near_duplicates(spark, docs(spark, rows))[0].collect()}
    assert got == {i: 50 if i == 51 else i for i, _ in rows}


def test_one_of_each_keeps_columns_and_one_row_of_each_class(spark):
    rows = corpus(6, families=4) + [(900, "only"), (900, "only"), (None, None), (None, "x y")]
    frame = docs(spark, rows)
    kept = J.one_of_each(spark, frame)
    assert kept.columns == frame.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    texts = sorted({t for _, t in rows if t})
    want = {find for find in classes([(k, t) for k, t in enumerate(texts)]).values()}
    assert len([t for _, t in got if t]) == len(want) and (None, None) in got
    assert J.one_of_each(spark, docs(spark, [])).collect() == []


def test_components_of_random_graphs(spark):
    rng = np.random.default_rng(4)
    chain = [(k, k + 1) for k in range(1000, 1040)]
    star = [(2000, 2000 + k) for k in range(1, 50)]
    edges = [tuple(map(int, e)) for e in rng.integers(0, 200, (150, 2))] + chain + star + [(5, 5), (1001, 1000)]
    parent = {v: v for e in edges for v in e}
    for a, b in edges:
        x, y = find(parent, a), find(parent, b)
        parent[max(x, y)] = min(x, y)
    got = components(spark, spark.createDataFrame(edges, "a long, b long")).collect()
    assert len({r["id"] for r in got}) == len(got)
    linked = {v for a, b in edges if a != b for v in (a, b)}
    assert {r["id"]: r["component"] for r in got} == {v: find(parent, v) for v in linked}
    assert components(spark, spark.createDataFrame([], "a long, b long")).collect() == []


def test_template_texts_stay_linear_in_the_blocks(spark, monkeypatch):
    """Texts that share a template, below the similarity, stay in oversize buckets to the last level."""
    rng = random.Random(21)
    template = words(rng, 60)
    rows = [(k, " ".join([*template, *words(rng, 30)])) for k in range(240)]
    rows += [(1000 + k, rows[k][1] + " " + words(rng, 1)[0]) for k in range(20)]
    limit, written, lists, emitted, real, brute = 20, {}, {}, [], J.materialize, J.brute_force

    def counting(session, df, label):
        out = real(session, df, label)
        written[label] = (out.count(), out.columns, [t for _, t in out.dtypes])
        if "meets" in out.columns:
            lists[label] = max((len(r["meets"]) for r in out.select("meets").collect()), default=0)
        return out

    monkeypatch.setattr(J, "materialize", counting)
    monkeypatch.setattr(J, "brute_force", lambda *a: emitted.append((pairs := brute(*a)).count()) or pairs)
    members, _ = J.near_duplicates(spark, docs(spark, rows), limit=limit, depth=1)
    assert {r["doc_id"]: r["class_id"] for r in members.collect()} == classes(rows)
    n, columns, _ = written["small-buckets"]
    hot = written["bucket-members-1"][0]
    # each member of a bucket goes to at most ceil(size / (limit / 2)) blocks, and equal buckets go once
    assert n <= 26 * (hot + written["bucket-members-0"][0])
    # the groups that a member names do not grow with the blocks, and no pair is sent twice
    assert lists["small-buckets"] <= 3 * J.RUNS
    assert emitted and max(emitted) <= 1.5 * 260


def test_equal_buckets_are_compared_once(spark):
    held = [(1, k) for k in range(5)] + [(2, k) for k in range(5)] + [(3, k) for k in range(4)] + [(4, k) for k in range(1, 6)]
    got = J.distinct_buckets(spark.createDataFrame(held, "bucket long, id long"))
    assert sorted(r["bucket"] for r in got.collect()) == [1, 3, 4]


@pytest.mark.parametrize("similarity", [0.8, 0.85, 0.9])
def test_trees_find_pairs_at_the_threshold(similarity):
    """The share of simulated pairs that meet in a bucket of one tree at least, with 0 to 4 splits."""
    rng = np.random.default_rng(int(100 * similarity))
    n, size = 400, 400
    both = round(2 * size * similarity / (1 + similarity))
    sigs = []
    for _ in range(n):
        pool = rng.integers(0, 2**63, 2 * size, dtype=np.uint64)
        sigs.append((J.signature(np.sort(pool[:size])), J.signature(np.sort(pool[size - both : 2 * size - both]))))
    left, right = (np.array([s[k] for s in sigs]) for k in (0, 1))
    met = {splits: np.zeros(n, bool) for splits in range(J.DEPTH + 1)}
    for run in range(J.RUNS):
        paths = np.full(n, J.mix(np.array([run + 1], np.uint64))[0])
        nodes = [(np.arange(n), paths)]
        for splits in range(J.DEPTH + 1):
            row, path = nodes[-1]
            a_row, a_child = J.children(path, left[row], J.SIMILARITY)
            b_row, b_child = J.children(path, right[row], J.SIMILARITY)
            pairs = {(int(row[r]), int(c)) for r, c in zip(a_row, a_child, strict=True)} & {
                (int(row[r]), int(c)) for r, c in zip(b_row, b_child, strict=True)}
            pairs = sorted(pairs)
            met[splits][[p for p, _ in pairs]] = True
            nodes.append((np.array([p for p, _ in pairs], np.int64), np.array([c for _, c in pairs], np.uint64)))
    assert all(hit.mean() >= 0.99 for hit in met.values()), {k: v.mean() for k, v in met.items()}


def test_buckets_without_pruned_candidates_are_compared_once(spark, monkeypatch):
    """A second pass runs only over buckets of which candidates were left, and then finds the rest."""
    passes, real = [], J.brute_force

    def counting(rows, similarity, everything):
        passes.append((everything, rows.select("bucket").distinct().count()))
        return real(rows, similarity, everything)

    monkeypatch.setattr(J, "brute_force", counting)
    rows = corpus(31, families=6, copies=3)
    members, _ = J.near_duplicates(spark, docs(spark, rows))
    assert {r["doc_id"]: r["class_id"] for r in members.collect()} == classes(rows)
    assert [everything for everything, _ in passes] == [False]
    passes.clear()
    rows = corpus(32, families=6, copies=3, hot=40)
    members, _ = J.near_duplicates(spark, docs(spark, rows))
    assert {r["doc_id"]: r["class_id"] for r in members.collect()} == classes(rows)
    assert len(passes) == 1 or passes[1][1] < passes[0][1]


def test_pruned_buckets_are_named():
    """Of many candidates a forest is sent and the bucket is cut; ``everything`` and few candidates leave none."""
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64) * np.uint64(2))
    for n, pruned in ((4, False), (30, True)):
        sketches = np.array([J.sketch(base)] * n)
        ids, sizes = np.arange(n), np.full(n, len(base))
        pairs, cut = J.bucket_pairs(ids, ids, sketches, sizes, 0.8, False)
        assert cut is pruned and (len(pairs) < n * (n - 1) // 2) is pruned
        pairs, cut = J.bucket_pairs(ids, ids, sketches, sizes, 0.8, True, 1, [{1}] * n)
        assert not cut and len(pairs) == n * (n - 1) // 2


def test_small_tables_take_few_tasks(spark, monkeypatch):
    """Tables that are measured small are written by few tasks, however many shuffle partitions there are."""
    from cardsentry.llm import components as C

    files, real = {}, J.materialize

    def counting(session, df, label):
        out = real(session, df, label)
        files.setdefault(label, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(J, "materialize", counting)
    monkeypatch.setattr(C, "materialize", counting)
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    was = [spark.conf.get(k) for k in keys]
    rows = corpus(33, families=30, copies=5, hot=40)
    try:
        for k, v in zip(keys, ("64", "false"), strict=True):
            spark.conf.set(k, v)
        got = J.counted(spark, docs(spark, rows)).collect()
        files_of = {k: max(v) for k, v in files.items()}
    finally:
        for k, v in zip(keys, was, strict=True):
            spark.conf.set(k, v)
    assert {r["doc_id"]: r["class_id"] for r in got} == classes(rows)
    assert {r["doc_id"]: r["n_links"] for r in got} == degrees(rows)
    cores = spark.sparkContext.defaultParallelism
    assert cores < 40
    for label in ("text-classes", "bucket-sizes-0", "bucket-members-0", "small-buckets", "links", "cc", "component-sizes", "link-counts"):
        assert files_of[label] <= cores, (label, files_of[label])


def test_components_end_when_the_links_are_stars(spark, monkeypatch):
    from cardsentry.llm import components as C

    rounds, real = [], C.materialize
    monkeypatch.setattr(C, "materialize", lambda *a: rounds.append(a[2]) or real(*a))
    edges = [(2000, 2000 + k) for k in range(1, 50)] + [(7, 3), (7, 7)]
    for rows in (0, 1000):  # by a shuffle join, by a broadcast
        rounds.clear()
        got = {r["id"]: r["component"] for r in components(spark, spark.createDataFrame(edges, "a long, b long"), broadcast_rows=rows).collect()}
        assert got == {2000 + k: 2000 for k in range(50)} | {3: 3, 7: 3}
        assert len(rounds) == 1  # the links as given
        chain = spark.createDataFrame([(k, k + 1) for k in range(20)], "a long, b long")
        assert {r["id"]: r["component"] for r in components(spark, chain, broadcast_rows=rows).collect()} == dict.fromkeys(range(21), 0)
