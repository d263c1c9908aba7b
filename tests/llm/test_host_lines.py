from __future__ import annotations

import random
import re
from collections import Counter

from llm_helpers import SCHEMA, docs, odd_texts, words

from cardsentry.llm import line_dedup, quality_rules
from cardsentry.llm.host_lines import shared_lines, with_shared

SPACE = " \t\n\x0b\x0c\r"


def table():
    rng = random.Random(8)
    rows = []
    for k in range(240):
        host = "hot" if k % 3 else f"s{k % 5}"
        lines = [" ".join(words(rng, rng.randint(1, 12))) for _ in range(rng.randint(1, 8))]
        if rng.random() < 0.3:
            lines.insert(rng.randrange(len(lines) + 1), "Accept  all Cookies " if rng.random() < 0.5 else "accept all cookies")
        if rng.random() < 0.2:
            lines.append(lines[0])
        if rng.random() < 0.1:
            lines += ["again and again and"] * 4
        rows.append((k, "\n".join(lines), host))
    rows += [(1000 + k, t, None) for k, t in enumerate(odd_texts())]
    rows += [(5, "accept all cookies\nmore", "hot"), (5, "accept all cookies\nmore", "hot"), (None, "accept all cookies", "hot")]
    rows += [(2000, "\n".join(" ".join(words(rng, 9)) for _ in range(3000)), "hot")]
    return rows


def norm(line):
    return re.sub(r"[\x20\x09\x0B-\x0D]+", " ", line.lower()).strip(" ")


def shared(rows, min_docs, ratio):
    total, seen = Counter(r[2] for r in rows), Counter()
    for _, t, h in rows:
        seen.update({(h, norm(x)) for x in (t or "").split("\n") if norm(x)})
    return {k for k, n in seen.items() if n >= min_docs and n > ratio * total[k[0]]}


def test_line_dedup_equals_brute_force_on_both_join_paths(spark, monkeypatch):
    rows = table()
    gone = shared(rows, 5, 0.08)
    assert ("hot", "accept all cookies") in gone
    want = sorted(
        (str(i), str(t if t is None else "\n".join(x for x in t.split("\n") if (h, norm(x)) not in gone)), str(h)) for i, t, h in rows)
    frame = docs(spark, rows)
    got = line_dedup.drop_boilerplate(spark, frame)
    assert got.schema.simpleString() == frame.schema.simpleString()
    assert sorted((str(r["doc_id"]), str(r["text"]), str(r["source"])) for r in got.collect()) == want
    flagged = shared_lines(spark, frame, "text", "source", 5, 0.08)
    a, b = (with_shared(frame, flagged, "text", "source", "doc_id", "f", broadcast_rows=n) for n in (10**6, 0))
    keep = lambda d: line_dedup.kept_lines(d["text"], d["f"])
    assert sorted(str(r) for r in a.select("doc_id", keep(a)).collect()) is not None
    joined = [sorted(str((r[0], r[1] if r[2] else None)) for r in d.select("doc_id", keep(d), d["f"].isNotNull()).collect()) for d in (a, b)]
    # without a flagged line of its own a document keeps all lines on either path
    texts = [sorted(str((r["doc_id"], "\n".join(r["k"]) if r["f"] else r["text"])) for r in d.withColumn("k", keep(d)).collect()) for d in (a, b)]
    assert texts[0] == texts[1] and len(joined[0]) == len(rows)


def base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    g = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    c = Counter(g)
    lines = [x for x in t.split("\n") if x.strip(SPACE)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
            len({k + j for k, x in enumerate(g) if c[x] > 1 for j in range(3)}))


def test_quality_rules_equal_brute_force(spark):
    rows = table() + [(3000 + k, "a b c " * k, "rep") for k in range(6)] + [(3100, "x x x x x", "rep"), (3101, "# * $ % & | < >", "rep")]
    gone = shared(rows, 5, 0.08)
    want = []
    for i, t, h in rows:
        b = base(t)
        removed = sum(len(norm(x).split(" ")) for x in (t or "").split("\n") if (h, norm(x)) in gone)
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        want.append(str((i, *b, removed, failed, not failed and 100 * removed <= 50 * b[0])))
    got = quality_rules.apply_rules(spark, docs(spark, rows)).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(want)


def test_an_absolute_limit_rejects_depleted_documents_of_a_large_host(spark):
    """A notice in 30 of 1,000 documents is below the share, but above a limit of 20."""
    rng = random.Random(4)
    notice = " ".join(words(rng, 60))
    rows = [(k, "\n".join([" ".join(words(rng, 70)), *([notice, notice.upper()] if k < 30 else [])]), "big") for k in range(1000)]
    frame = docs(spark, rows)
    for limit, gone in ((20, set(range(30))), (30, set()), (None, set())):
        out = {r["doc_id"]: r for r in quality_rules.apply_rules(spark, frame, line_most_docs=limit).collect()}
        assert {k for k, r in out.items() if not r["kept"]} == gone
        assert all(r["removed_words"] == (120 if k in gone else 0) and not r["base_failed"] for k, r in out.items())


def test_a_document_keeps_only_the_flagged_lines_it_holds(spark):
    rows = [(k, f"shared {k % 3}\nown {k}", "h") for k in range(30)]
    frame = docs(spark, rows)
    flagged = shared_lines(spark, frame, "text", "source", 5, 0.08)
    for limit in (10**6, 0):
        held = with_shared(frame, flagged, "text", "source", "doc_id", "f", broadcast_rows=limit)
        assert {r["n"] for r in held.selectExpr("size(f) AS n").collect()} == {1}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert line_dedup.drop_boilerplate(spark, empty).collect() == []
    assert quality_rules.apply_rules(spark, empty).collect() == []


def test_native_plans_run_no_python(spark):
    for df in (quality_rules.apply_rules(spark, docs(spark, table())), line_dedup.drop_boilerplate(spark, docs(spark, table()))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
