from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline as P
from llm_helpers import docs, odd_texts, words
from pyspark.sql import functions as F

from cardsentry.llm import queries
from cardsentry.llm.common import materialize, table
from test_host_lines import norm, shared
from test_jaccard_join import classes

SF = "/root/testdata/sf0.001"


def test_stages_in_order_against_brute_force(spark):
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "line_dedup", "jaccard_join", "decontaminate", "packing"]
    frame = table(spark, SF, "documents")
    kept, rows = [frame], [{r["doc_id"]: r for r in frame.collect()}]
    for name, stage in P.STAGES:
        out = materialize(spark, stage(spark, kept[-1], SF), f"test-{name}")
        if name != "packing":
            assert out.columns == frame.columns
            rows.append({r["doc_id"]: r for r in out.collect()})
            assert len(rows[-1]) == out.count()
        kept.append(out)
    start, good, lines, unique, clean = rows
    score = {r["doc_id"]: r["predicted"] for r in queries.op7_quality_classifier(spark, SF).collect()}
    assert set(good) == {i for i in start if score[i] == 1}
    triples = [(i, r["text"], r["source"]) for i, r in good.items()]
    gone = shared(triples, 5, 0.08)
    assert {i: r["text"] for i, r in lines.items()} == {
        i: "\n".join(x for x in t.split("\n") if (h, norm(x)) not in gone) for i, t, h in triples}
    of = classes([(i, r["text"]) for i, r in lines.items()])
    assert Counter(of[i] for i in unique) == Counter(set(of.values()))
    items = [r["text"] for r in table(spark, SF, "benchmark").collect()]
    assert set(clean) <= set(unique)
    assert not any(t in r["text"] for r in clean.values() for t in items)
    assert all(any(t[:40] in unique[i]["text"] for t in items) for i in set(unique) - set(clean))
    packed = kept[-1].collect()
    assert {r["doc_id"] for r in packed} == set(clean)
    whole = P.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in whole) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed)


def odd_documents():
    rng = random.Random(12)
    texts = odd_texts() + ["\n".join(" ".join(words(rng, 12)) for _ in range(6)) for _ in range(12)]
    rows = [(k, t, f"s{k % 2}") for k, t in enumerate(texts)]
    rows += [(None, texts[-1], "s0"), (None, None, None), (3, "twice", "s1"), (3, "twice", "s1"), (900, " ".join(words(rng, 60_000)), "s0")]
    return rows + [(901, texts[-2] + " and a word", "s1")]


def test_stages_on_odd_rows_and_clashing_columns(spark):
    """Nulls, empty, blank, repeated and very long texts, with columns named like the stages' own."""
    rows = odd_documents()
    frame = docs(spark, rows).withColumnsRenamed({"score": "label", "row": "key"})
    for name in ("count", "n", "line", "keys", "id", "a", "b", "text_class", "class_id", "word", "item_id"):
        frame = frame.withColumn(name, F.lit(name))
    now = frame
    for name, stage in P.STAGES:
        out = materialize(spark, stage(spark, now, SF), f"odd-{name}")
        if name == "packing":
            assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in now.collect()}
            continue
        assert out.columns == now.columns, name
        assert out.count() <= now.count()
        if name == "line_dedup":
            assert out.count() == now.count()
        now = out


def test_near_duplicate_and_decontamination_stages_on_odd_rows(spark):
    """Without the classifier, which rejects most of these rows."""
    rows = odd_documents()
    frame = docs(spark, rows)
    kept = P.near_duplicates(spark, frame, SF)
    got = sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect())
    texts = [r[1] or "" for r in rows]
    assert len([t for _, t in got if t == "twice"]) == 1  # a repeated row is one of its class
    assert ("None", "") in got and ("900", texts[[r[0] for r in rows].index(900)]) in got
    assert sum(t == texts[[r[0] for r in rows].index(901)] or t == rows[-7][1] for _, t in got) <= 2
    clean = P.decontamination(spark, frame, SF)
    assert clean.count() == len(rows)  # nothing here holds a benchmark item


def test_stages_on_an_empty_table(spark):
    now = docs(spark, [(1, "x")]).limit(0)
    for name, stage in P.STAGES:
        now = materialize(spark, stage(spark, now, SF), f"empty-{name}")
        assert now.count() == 0


def test_registry_names():
    names = [n for n in queries.registry() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
