from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from llm_helpers import docs, odd_texts, words

public_tokenizers = pytest.importorskip("public_tokenizers")

from cardsentry.llm import packing  # noqa: E402
from cardsentry.llm.common import IdEncoder, tokenizer  # noqa: E402

PATHS = {n: public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}


@pytest.mark.parametrize("name", PATHS)
def test_encoder_equals_the_library(name):
    rng = random.Random(1)
    texts = odd_texts() + [" ".join(words(rng, 200)) + ", the end's.\nNext: it's 12 #$% ok" for _ in range(20)]
    enc = IdEncoder(PATHS[name], 7, memo_size=300)  # the memo fills up on the way
    for _ in range(2):
        got = enc.encode_batch(texts)
        for t, g in zip(texts, got, strict=True):
            want = tokenizer(PATHS[name]).encode(t or "", add_special_tokens=False).ids + [7]
            assert np.frombuffer(g, "<u4").tolist() == want, t


def test_fullest_is_the_best_subset_sum():
    rng = random.Random(2)
    for _ in range(60):
        available = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(5)}
        room = rng.randint(0, 60)
        combo = packing.fullest(available, room)
        assert all(n <= available[k] for k, n in combo)
        items = [k for k, n in available.items() for _ in range(n)]
        best = max(s for r in range(len(items) + 1) for c in itertools.combinations(items, r) if (s := sum(c)) <= room)
        assert sum(k * n for k, n in combo) == best


def test_plan_uses_every_piece_once_and_fits():
    rng = random.Random(3)
    histogram = {rng.randint(1, 100): rng.randint(1, 50) for _ in range(60)}
    patterns = packing.plan(histogram, 100)
    used: dict[int, int] = {}
    for bins, combo in patterns:
        assert bins > 0 and sum(k * n for k, n in combo) <= 100
        for k, n in combo:
            used[k] = used.get(k, 0) + n * bins
    assert used == histogram
    rooms: list[int] = []  # first fit decreasing
    for k in sorted((k for k, n in histogram.items() for _ in range(n)), reverse=True):
        at = next((i for i, room in enumerate(rooms) if room >= k), None)
        if at is None:
            rooms.append(100 - k)
        else:
            rooms[at] -= k
    assert sum(b for b, _ in patterns) <= len(rooms)


def check(rows, texts, capacity):
    enc = IdEncoder(PATHS["word_bpe_49k.json"], 1)
    want = []
    for i, raw in zip([t[0] for t in texts], enc.encode_batch([t[1] for t in texts]), strict=True):
        for k in range(-(-len(raw) // (4 * capacity))):
            part = raw[4 * capacity * k : 4 * capacity * (k + 1)]
            want.append((i, k, k * capacity, len(part) // 4, zlib.crc32(part)))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([tuple(r)[:5] for r in rows], key=key) == sorted(want, key=key)
    by_sequence: dict[int, list] = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in by_sequence.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), -(-sum(r["length"] for r in rows) // capacity)


def test_pack_odd_long_and_repeated_rows(spark):
    rng = random.Random(4)
    texts = [(k, t) for k, t in enumerate(odd_texts())] + [(None, "null id"), (100, " ".join(words(rng, 900)))]
    texts += [(200, "same text here")] * 30 + [(300 + k, " ".join(words(rng, rng.randint(1, 60)))) for k in range(60)]
    rows = packing.pack(spark, docs(spark, texts), PATHS["word_bpe_49k.json"], capacity=128).collect()
    used, bound = check(rows, texts, 128)
    assert used <= bound + 2


def test_pack_empty_table(spark):
    assert packing.pack(spark, docs(spark, []), PATHS["word_bpe_49k.json"]).collect() == []


def test_a_hot_length_is_dealt_by_its_count():
    """A third of all pieces share one length: neither a group of them nor their number of groups grows in proportion."""
    for n in (10, 4096, 10**6, 10**9, 10**11):
        groups = packing.buckets_of({4096: n, 7: 2 * n // 4000 + 1})[4096]
        assert 1 <= groups and n / groups <= max(packing.RANKED, 8 * n**0.5 + 1) and groups <= n**0.5 + 1
    assert packing.buckets_of({4096: 10**6})[4096] > 100
