from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from llm_helpers import docs, odd_texts, words

public_tokenizers = pytest.importorskip("public_tokenizers")

from cardsentry.llm import token_output as T  # noqa: E402
from cardsentry.llm.common import tokenizer  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_hash_is_minimal_and_perfect(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 62, n).astype(np.uint64))
    mph = T.PerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(len(keys)))


def ids_of(t):
    return tokenizer(PATH).encode(t or "", add_special_tokens=False).ids + [0]


def written(spark, texts, scratch, shards=4):
    folder = f"{scratch}/shards"
    manifest = T.write_shards(spark, docs(spark, texts), folder, PATH, 0, 2, shards=shards)
    return folder, manifest


def test_round_trip_with_nulls_repeats_and_long_texts(spark, scratch):
    rng = random.Random(5)
    texts = [(7 * k - 20, t) for k, t in enumerate(odd_texts())] + [(500, "one"), (500, "two"), (500, "one"), (None, "no key")]
    texts += [(900, " ".join(words(rng, 20_000)))]
    folder, manifest = written(spark, texts, scratch)
    got = T.read_shards(spark, manifest, folder, 2).collect()
    crc = lambda t: zlib.crc32(np.array(ids_of(t), "<u4").tobytes())
    assert sorted((r["doc_id"] is not None, r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(
        (i is not None, i, len(ids_of(t)), crc(t)) for i, t in texts)
    # starts are gapless in ascending id order, null first
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order[0] is None and order[1:] == sorted(order[1:])


def test_keyed_access_and_unknown_keys(spark, scratch):
    texts = [(k, f"text number {k}") for k in range(0, 300, 3)] + [(30, "a second text")]
    folder, manifest = written(spark, texts, scratch)
    rows = manifest.collect()
    for key in (0, 30, 297):
        got = sorted(x.tolist() for x in T.lookup(rows, folder, 2, key))
        assert got == sorted(ids_of(t) for i, t in texts if i == key)
    assert all(T.lookup(rows, folder, 2, key) == [] for key in (-1, 1, 299, 10**9))


def test_a_look_up_reads_the_same_few_bytes_at_every_size(spark, scratch):
    read = {}
    for n in (200, 20_000):
        texts = [(7 * k, f"t{k % 10}") for k in range(n)] + [(7, "again")]
        folder, manifest = written(spark, texts, f"{scratch}/{n}", shards=1)
        reader = T.Reader(manifest.collect(), folder, 2)
        (name,) = [r["name"] for r in manifest.collect()]
        reader.get(0)  # opens the shard
        sizes = []
        for key in random.Random(n).sample(range(0, 7 * n, 7), 100):
            before = reader.shard(name).bytes_read
            got = reader.get(key)
            sizes.append(reader.shard(name).bytes_read - before)
            assert sorted(x.tolist() for x in got) == sorted(ids_of(t) for i, t in texts if i == key) if key < 70 else len(got) == 1
        read[n] = np.mean(sizes)
        assert all(reader.get(key) == [] for key in (1, 13, -7, 10**12))
    assert read[20_000] < 1.3 * read[200] < 400


def test_a_reader_keeps_a_bounded_number_of_shards_open(spark, scratch, monkeypatch):
    texts = [(k, f"text {k}") for k in range(60)]
    folder, manifest = written(spark, texts, scratch, shards=6)
    monkeypatch.setattr(T, "OPEN", 2)
    reader = T.Reader(manifest.collect(), folder, 2)
    for k, t in texts + texts[::-1]:
        assert [x.tolist() for x in reader.get(k)] == [ids_of(t)] and len(reader.open) <= 2


def test_shards_are_bounded_by_bytes(spark, scratch, monkeypatch):
    monkeypatch.setattr(T, "SHARD_BYTES", 200)
    texts = [(k, "some words of a text " * 5) for k in range(60)]
    manifest = T.write_shards(spark, docs(spark, texts), f"{scratch}/s", PATH, 0, 2).collect()
    assert len(manifest) > 20 and sum(r["n_records"] for r in manifest) == 60


def test_rewriting_the_same_shards_changes_nothing(spark, scratch):
    texts = [(k, f"row {k}") for k in range(50)]
    folder, first = written(spark, texts, scratch)
    before = sorted(map(tuple, T.read_shards(spark, first, folder, 2).collect()))
    _, again = written(spark, texts, scratch)  # as a repeated task would
    assert sorted(map(tuple, T.read_shards(spark, again, folder, 2).collect())) == before


def test_empty_table(spark, scratch):
    folder, manifest = written(spark, [], scratch)
    assert T.read_shards(spark, manifest, folder, 2).collect() == []
