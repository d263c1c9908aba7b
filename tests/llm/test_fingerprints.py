from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import docs, odd_texts, words

from cardsentry.llm import fingerprints as fp
from cardsentry.llm import queries


def prose(rng, lines):
    return "\n".join(". ".join(" ".join(words(rng, 8)) for _ in range(rng.randint(1, 5))) + "." for _ in range(lines))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=80), st.sets(st.integers(0, 2**64 - 1), max_size=80), st.integers(0, 60))
def test_peeling_recovers_the_differences(a, b, n):
    common = set(range(1000, 1000 + n))
    ours, theirs = (np.array(sorted(x | common), np.uint64) for x in (a, b))
    ((gone, new, _),) = fp.differences([ours], [theirs])
    a, b = set(ours.tolist()), set(theirs.tolist())
    assert set(gone.tolist()) == a - b and set(new.tolist()) == b - a
    assert len(gone) == len(a - b) and len(new) == len(b - a)


def test_differences_retry_larger_only_where_needed():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (0, 3, 40, 5000, 100_000)]
    others = [s[: len(s) * 9 // 10] for s in sets]
    found = fp.differences(sets, others)
    for s, o, (gone, new, _) in zip(sets, others, found, strict=True):
        assert sorted(gone.tolist()) == sorted(s[len(o) :].tolist()) and not len(new)
    cells = [c for *_, c in found]
    assert cells[0] == cells[1] == fp.CELLS < cells[3] < cells[4] <= 32_768


def test_fingerprint_text_decodes_to_the_sketch():
    ours = fp.digests(prose(random.Random(1), 2))
    cells = np.frombuffer(base64.b64decode(fp.sketched([ours], fp.CELLS).written()[0]), [("n", "<i4"), ("k", "<u8"), ("c", "<u4")])
    assert len(cells) == fp.TABLES * fp.CELLS and cells["n"].sum() == fp.TABLES * len(ours)


def test_paragraphs_are_short_and_local():
    rng = random.Random(2)
    long = " ".join(words(rng, 3000))
    for text in (long, "x" * 5000, prose(rng, 40)):
        parts = fp.paragraphs(text)
        assert all(0 < len(p) <= fp.SHORT for p, _ in parts) and len(parts) > 10
    near = len(set(fp.digests(long)) & set(fp.digests("one more word " + long)))
    assert near > 0.9 * len(fp.digests(long))  # an insertion shifts only its own paragraph


def test_copies_within_a_text_count():
    a, b = fp.digests("same\nsame\nsame\n"), fp.digests("same\nsame")
    assert len(set(a.tolist())) == 3
    ((gone, new, _),) = fp.differences([a], [b])
    assert len(gone) == 1 and not len(new)


def test_digests_differ_for_short_paragraphs_with_many_copies():
    text = " ".join(["im. im", "den. der"] * 40) + "\nim.\nim\n" + ". ".join(["a", "b", "ab"] * 60)
    found = fp.digests(text)
    assert len(set(found.tolist())) == len(found) == len(fp.paragraphs(text))


def brute_next(rows):
    """Rows by id (null last); within one id the order is any."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    return [(a, b) for a, b in zip(order, order[1:] + order[:1], strict=True)]


@pytest.mark.parametrize("parts", [2, 40])
def test_next_row(spark, parts):
    rng = random.Random(parts)
    ids = rng.sample(range(-500, 10**15), 50) + list(range(100, 160)) + [2**62, -(2**62), 2**53 + 1, 2**53 + 2]
    rows = [(i, f"text of {i}") for i in dict.fromkeys(ids)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {r["doc_id"]: (r["text"], r["next"]) for r in fp.with_next(spark, docs(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == {a[0]: (a[1], b[1]) for a, b in brute_next(rows)}


def test_next_of_repeated_null_and_single_rows(spark):
    rows = [(5, "a")] * 40 + [(7, "b"), (None, "n"), (None, "n"), (1, None)]
    got = sorted((str(r["doc_id"]), r["text"], r["next"]) for r in fp.with_next(spark, docs(spark, rows)).collect())
    want = [("1", "", "a")] + [("5", "a", "a")] * 39 + [("5", "a", "b"), ("7", "b", "n"), ("None", "n", ""), ("None", "n", "n")]
    assert got == sorted(want)
    assert [r["next"] for r in fp.with_next(spark, docs(spark, [(3, "only")])).collect()] == ["only"]
    assert fp.with_next(spark, docs(spark, [(3, "only")]).limit(0)).collect() == []


def test_operator_on_odd_rows(spark):
    texts = [t or "" for t in odd_texts()] + [prose(random.Random(3), 30)]
    rows = spark.createDataFrame([(i, a, b, "x") for i, (a, b) in enumerate((a, b) for a in texts for b in texts)],
                                 "doc_id long, mine string, yours string, fingerprint string")
    got = fp.compare_versions(spark, rows, "doc_id", "mine", ["yours"], with_digests=True).collect()
    assert len(got) == len(texts) ** 2
    for r in got:
        a, b = (set(fp.digests(t).tolist()) for t in (texts[r["doc_id"] // len(texts)], texts[r["doc_id"] % len(texts)]))
        assert {x % 2**64 for x in r["gone_yours"]} == a - b and {x % 2**64 for x in r["new_yours"]} == b - a
        assert r["near_yours"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        if r["doc_id"] // len(texts) == r["doc_id"] % len(texts):
            assert r["fingerprint"] == r["fingerprint_yours"] and r["near_yours"] == 1.0


def test_query(spark, tmp_path):
    rng = random.Random(4)
    rows = [(k, prose(rng, rng.randint(1, 60)) + " 🙂é" * (k % 3)) for k in rng.sample(range(10_000), 80)]
    rows += [(10_001, rows[0][1]), (10_002, rows[0][1]), (10_003, None), (10_004, "ab")]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op13_fingerprints(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for (doc_id, text), (_, after) in brute_next(rows):
        text, after, r = text or "", after or "", got[doc_id]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for name, other in (("near_edited", edited), ("near_next", after)):
            a, b = set(fp.digests(text).tolist()), set(fp.digests(other).tolist())
            assert r[name] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    assert got[rows[0][0]]["fingerprint"] == got[10_001]["fingerprint"] and got[10_001]["near_next"] == 1.0
    long = [got[i] for i, t in rows if t and len(t) > 2000 and i < 10_000]
    assert min(r["near_edited"] for r in long) > 0.4 > max(r["near_next"] for r in long)
