from __future__ import annotations

import zlib

import duckdb
import numpy as np
from llm_helpers import docs, odd_texts

from cardsentry.llm import language_id as L
from cardsentry.llm import quality_classifier as C
from cardsentry.llm import queries

SF = "/root/testdata/sf0.01"


def remainder(i, m):
    return zlib.crc32(str(i).encode()) % m


def test_language_id_held_out_accuracy_and_folds(spark):
    rows = queries.op5_language_id(spark, SF).collect()
    lang = dict(duckdb.connect().execute(f"select doc_id, lang from '{SF}/documents.parquet'").fetchall())
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (remainder(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"] and lang[r["doc_id"]]]
    assert np.mean(held) > 0.98


def test_language_id_does_not_read_other_columns_and_defines_odd_cases(spark):
    train = [("the cat sat on the mat and the dog ran to the house", "en")] * 40 + [
        ("le chat est sur la table et le chien dans la maison", "fr")] * 40
    model = L.fit(train)
    rows = [(k, t) for k, t in enumerate(odd_texts())] + [(50, "the dog and the cat"), (50, "the dog and the cat"), (None, "la maison et le chat"),
                                                          (60, "the cat sat on the mat. " * 40_000)]
    got = L.identify(spark, docs(spark, rows, lang="xx"), model).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert by[0] == by[1] == by[2] == by[3] == [("und", 0.0)]  # null, empty, blank
    assert by[15] == [("und", 0.0)]  # digits only
    assert by[50][0] == by[50][1] and by[50][0][0] == "en"
    assert by[60][0][0] == "en" and by[None][0][0] == "fr"
    assert L.identify(spark, docs(spark, []), model).collect() == []
    assert L.fit([]) is None
    assert {r["lang_pred"] for r in L.identify(spark, docs(spark, rows[:3]), None).collect()} == {"und"}


def test_language_scores_do_not_depend_on_the_stretch(monkeypatch):
    model = L.fit([("abc def ghi " * 5, "x")] * 20 + [("uvw xyz rst " * 5, "y")] * 20)
    texts = ["abc uvw " * 300, "", "def", "xyz rst abc " * 100]
    whole = L.scores(model, texts)
    monkeypatch.setattr(L, "STRETCH", 64)
    assert np.allclose(whole, L.scores(model, texts), atol=1e-9)


def test_language_scores_equal_brute_force():
    """Every window's bucket looked up alone, averaged, in plain Python."""
    model = L.fit([("the cat and the dog ran", "en")] * 30 + [("le chat et le chien dans", "fr")] * 30 + [("der hund und die katze", "de")] * 30)
    texts = ["the dog", "Le CHIEN, 12 chats!", "x", "", "Größe und straße " * 30, "a1b2c3"]
    for text, got in zip(texts, L.scores(model, texts), strict=True):
        raw = b" " + bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in text.lower().encode()) + b" "
        z, n = np.zeros(len(model.langs)), 0
        for size in (2, 3, 4):
            for a in range(len(raw) - size + 1):
                x = int.from_bytes(raw[a : a + size], "little")
                bucket = ((x * 2654435761 + size * 40503) % 2**32 * 2246822519) % 2**32 >> (32 - model.bits)
                z += model.table[bucket]
                n += 1
        z = (z / max(n, 1) + model.bias) / model.temperature
        want = np.exp(z - z.max())
        assert np.allclose(got, want / want.sum(), atol=1e-6), text


def test_language_sample_is_bounded_in_all(spark):
    rows = [(k, f"text of language {k % 12} number {k}") for k in range(1200)]
    from pyspark.sql import functions as F

    table = docs(spark, rows).withColumn("lang", (F.col("doc_id") % 12).cast("string"))
    got = L.sample(table, L.Training(per_lang=1500, total=240), "doc_id", "text", "lang", F.lit(True))
    assert 120 < len(got) <= 480 and len({y for _, y in got}) == 12
    whole = L.sample(table, L.Training(), "doc_id", "text", "lang", F.lit(True))
    assert len(whole) == 1200


def test_quality_scores_equal_brute_force():
    """The network's formula, filter by filter and window by window, in plain numpy."""
    model = small_quality_model()
    for text in ("", "x", "plain words in a calm order. " * 40, "@@## $$%% é ü 日本 " * 30):
        raw = text.encode()
        n = max(2, -(-len(raw) // C.HALF)) * C.HALF
        sym = [*raw, *[256] * (n + C.WIDTH - 1 - len(raw))]
        emb, conv = model.emb.astype(float), model.conv.astype(float)
        response = np.array([sum(emb[sym[p + j]] @ conv[j] for j in range(C.WIDTH)) for p in range(n)])
        # chunks of two halves, moved by one half
        chunks = np.array([response[a : a + 2 * C.HALF].max(axis=0) for a in range(0, n - C.HALF, C.HALF)])
        v = np.maximum(chunks, 0)
        x = np.concatenate([v.mean(axis=0), v.max(axis=0), v.min(axis=0)])
        z = np.maximum(x @ model.w1 + model.b1, 0) @ model.w2 + model.b2 + model.shift
        assert np.isclose(C.score(model, text), 1 / (1 + np.exp(-z)), atol=1e-4), text


def test_quality_held_out(spark):
    rows = queries.op7_quality_classifier(spark, SF).collect()
    label = dict(duckdb.connect().execute(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall())
    assert all(r["held_out"] == (remainder(r["doc_id"], 5) == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [(label[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in label]
    assert np.mean([p for y, p in held if y == 1]) > 0.95
    assert np.mean([p for y, p in held if y == 0]) < 0.4


def small_quality_model():
    good = "plain words in a calm and varied order, one after another and so on. "
    bad = "@@## $$%% ^^&& "
    rows = [(good * k, 1) for k in range(1, 30)] + [(bad * k, 0) for k in range(1, 30)]
    return C.fit(rows, 0.5, C.Training(epochs=4, filters=8, hidden=8, batch=8))


def test_quality_scores_whole_documents(monkeypatch):
    model = small_quality_model()
    long = "plain words in a calm order. " * 2000
    assert C.score(model, long) > 0.5 > C.score(model, "@@## $$%% ^^&& " * 50)
    # a stretch's size does not matter, and bytes at the very end are seen
    at_end = C.pooled_halves(model, C.padded((long + "@@## $$%% ^^&&" * 9).encode()))
    monkeypatch.setattr(C, "STRETCH", 3)
    again = C.pooled_halves(model, C.padded((long + "@@## $$%% ^^&&" * 9).encode()))
    assert np.array_equal(at_end, again)
    assert not np.allclose(at_end[-1], at_end[0])


def test_quality_conv_tables_equal_a_direct_convolution():
    model = small_quality_model()
    sym = C.padded(b"some bytes to convolve, more than one half chunk " * 6)
    table = model.tables()
    n = len(sym) - C.WIDTH + 1
    direct = sum(table[k][sym[k : k + n]] for k in range(C.WIDTH)).reshape(-1, C.HALF, table.shape[2]).max(axis=1)
    assert np.allclose(direct, C.pooled_halves(model, sym), atol=1e-4)


def test_quality_odd_cases(spark):
    rows = [(k, t) for k, t in enumerate(odd_texts())] + [(90, "twice"), (90, "twice"), (None, "no id")]
    table = docs(spark, rows)
    got = C.with_scores(spark, table, small_quality_model(), into="quality_score").collect()
    assert len(got) == len(rows) and all(0 <= r["quality_score"] <= 1 for r in got)
    assert got[0].asDict().keys() == {*table.columns, "quality_score"}
    twice = [r["quality_score"] for r in got if r["doc_id"] == 90]
    assert twice[0] == twice[1]
    null, empty = (next(r["quality_score"] for r in got if r["doc_id"] == k) for k in (0, 1))
    assert null == empty
    assert C.with_scores(spark, docs(spark, []), 0.5, into="s").collect() == []
    # labels of one class, of no class, null and repeated ones
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    from pyspark.sql import functions as F

    sample, share = C.sample(table, labels, C.Training(), "doc_id", "text", "quality", F.lit(True))
    assert sample == [("", 0)] and share == 0.0 and C.fit(sample, share) == 0.0
    assert C.sample(table, labels.where("false"), C.Training(), "doc_id", "text", "quality", F.lit(True)) == ([], 0.5)
