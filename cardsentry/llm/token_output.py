"""Token-id output: raw id shards with a minimal perfect hash index.

Documents are dealt into shards by ranges of their key and written in key
order.  A shard is two files:

* ``part-NNNNN.ids``: the ids of its documents, little-endian, two bytes an id
  if the vocabulary fits, else four; nothing else;
* ``part-NNNNN.mph``: a header and little-endian arrays (``SECTIONS``): record offsets and
  keys in file order and the index: a minimal perfect hash over the distinct keys gives a
  slot, the slot holds the key's 32-bit fingerprint, its first record and its
  number of records.  A look-up (``Reader``) reads a block of bits and its rank for
  each level that it passes (fewer than two on average), then one entry of each array and the payload:
  some two hundred bytes besides the ids, whatever the number of keys.

The perfect hash keeps, level by level, a bit array in which keys alone at
their position are settled; the others go on to the next level; the rank of a
key's bit is its slot (Limasset et al., 2017).  Ranks are stored for every block of
``RANKED`` bits.

A task writes under an attempt's own name and renames when complete, so a lost
or repeated task leaves either nothing or the same files.  Files are opened
with ``pyarrow.fs`` by the URI of the shared folder.

Defined results: null and empty text is the end id alone; a repeated key has
one index entry and its records follow each other; a null key sorts first, is
written and listed, but cannot be looked up; texts of any length are encoded whole; an
empty table has no shards; other columns are not read, so none can clash.
"""

from __future__ import annotations

import bisect
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import encoder, materialize, prepare

GAMMA = 2.0
#: Bits of the perfect hash between two stored ranks.
RANKED = 512
#: Bytes of text in a shard, about; there are at least as many shards as the session's shuffle partitions.
SHARD_BYTES = 1 << 28
#: Shards that a reader keeps open.
OPEN = 64
MAGIC = b"MPHSHARD"
#: The arrays of an index file, in order.
SECTIONS = (("sizes", "<i8"), ("ranks", "<i8"), ("bits", "u1"), ("prints", "<u4"), ("first", "<i8"), ("count", "<i8"),
            ("offsets", "<i8"), ("keys", "<i8"), ("valid", "u1"))
MANIFEST = "shard long, name string, n_records long, n_ids long, first_key long, last_key long"
RECORDS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit mixing of integer keys (splitmix64 finaliser; a bijection for each seed)."""
    with np.errstate(over="ignore"):
        z = keys + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1009) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


class PerfectHash:
    """Minimal perfect hash over distinct unsigned 64-bit keys."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.level_at = np.concatenate([[0], np.cumsum(sizes)])
        self.flat = np.unpackbits(bits, count=int(self.level_at[-1])).astype(bool)
        self.rank = np.cumsum(self.flat) - 1

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], keys
        while len(left):
            size = max(8, int(GAMMA * len(left)))
            at = (mix(left, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at]]
        flat = np.concatenate(levels) if levels else np.zeros(0, bool)
        return cls(np.array(sizes, np.int64), np.packbits(flat))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 or any slot for a key that was not built in."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(todo):
                break
            at = (mix(keys[todo], level + 1) % np.uint64(size)).astype(np.int64) + self.level_at[level]
            hit = self.flat[at]
            out[todo[hit]] = self.rank[at[hit]]
            todo = todo[~hit]
        return out


def filesystem(uri: str):
    """(file system, path) of a folder named by URI or by an absolute path."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def build_index(keys: np.ndarray, valid: np.ndarray, lengths: np.ndarray) -> bytes:
    """Index file of records in key order."""
    found, first, count = np.unique(keys[valid], return_index=True, return_counts=True)
    first = first + np.count_nonzero(~valid)  # records without a key come first
    u = found.astype(np.int64).view(np.uint64)
    mph = PerfectHash.build(u)
    slot = mph.slots(u)
    prints, at, n = np.zeros(len(u), np.uint32), np.zeros(len(u), np.int64), np.zeros(len(u), np.int64)
    prints[slot], at[slot], n[slot] = fingerprint(u), first, count
    ones = np.add.reduceat(mph.flat, np.arange(0, len(mph.flat), RANKED)) if len(mph.flat) else np.zeros(0, np.int64)
    arrays = {"sizes": mph.sizes, "ranks": np.cumsum(ones) - ones, "bits": mph.bits, "prints": prints, "first": at, "count": n,
              "offsets": np.concatenate([[0], np.cumsum(lengths)]), "keys": keys, "valid": valid}
    parts = [np.ascontiguousarray(arrays[name].astype(kind)).tobytes() for name, kind in SECTIONS]
    sizes = np.array([len(p) for p in parts], "<i8").tobytes()
    return MAGIC + sizes + b"".join(parts)


class Shard:
    """One shard: keyed access by reads of a few bytes, or (``load``) all arrays at once."""

    def __init__(self, folder: str, name: str, id_bytes: int):
        self.fs, path = filesystem(folder)
        self.name, self.dtype = name, np.dtype(f"<u{id_bytes}")
        self.index = self.fs.open_input_file(f"{path}/{name}.mph")
        self.payload = self.fs.open_input_file(f"{path}/{name}.ids")
        self.bytes_read = 0
        head = self.read(self.index, 0, len(MAGIC) + 8 * len(SECTIONS))
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{name}: not an index file")
        sizes = np.frombuffer(head[len(MAGIC) :], "<i8")
        begins = len(head) + np.cumsum(sizes) - sizes
        self.place = {n: (int(b), int(z), np.dtype(kind)) for (n, kind), b, z in zip(SECTIONS, begins, sizes, strict=True)}
        self.levels = self.entries("sizes")  # the logarithm of the number of keys
        self.level_at = np.concatenate([[0], np.cumsum(self.levels)])

    def read(self, file, at: int, size: int) -> bytes:
        self.bytes_read += size
        return file.read_at(size, at)

    def entries(self, name: str, at: int = 0, n: int | None = None) -> np.ndarray:
        """``n`` entries of an array from entry ``at`` on (all of it by default)."""
        begin, size, kind = self.place[name]
        size = size if n is None else n * kind.itemsize
        return np.frombuffer(self.read(self.index, begin + at * kind.itemsize, size), kind)

    def load(self) -> "Shard":
        for name in ("bits", "prints", "first", "count", "offsets", "keys", "valid"):
            setattr(self, name, self.entries(name))
        self.valid = self.valid.astype(bool)
        self.mph = PerfectHash(self.levels, self.bits)
        return self

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key (0 records: unknown key), from the loaded arrays."""
        u = np.asarray(keys, np.int64).view(np.uint64)
        slot = self.mph.slots(u)
        ok = slot >= 0
        ok[ok] = self.prints[slot[ok]] == fingerprint(u[ok])
        first, n = np.zeros(len(u), np.int64), np.zeros(len(u), np.int64)
        first[ok], n[ok] = self.first[slot[ok]], self.count[slot[ok]]
        return first, n

    def slot(self, key: np.ndarray) -> int:
        """Slot of one unsigned key, read from the file; -1 if no level settles it."""
        for level, size in enumerate(self.levels.tolist()):
            bit = int(mix(key, level + 1)[0] % np.uint64(size)) + int(self.level_at[level])
            block = bit // RANKED
            begin = block * RANKED // 8
            held = min(RANKED // 8, self.place["bits"][1] - begin)
            bits = np.unpackbits(self.entries("bits", begin, held))
            if bits[bit - block * RANKED]:
                return int(self.entries("ranks", block, 1)[0]) + int(bits[: bit - block * RANKED].sum())
        return -1

    def records(self, key: int) -> range:
        """The records of a key, by reads whose size does not depend on the shard's."""
        if not self.place["first"][1]:
            return range(0)
        u = np.array([key], np.int64).view(np.uint64)
        slot = self.slot(u)
        if slot < 0 or self.entries("prints", slot, 1)[0] != fingerprint(u)[0]:
            return range(0)
        first, n = int(self.entries("first", slot, 1)[0]), int(self.entries("count", slot, 1)[0])
        # another key can share slot and fingerprint
        return range(first, first + n) if self.entries("keys", first, 1)[0] == key else range(0)

    def ids(self, record: int) -> np.ndarray:
        a, b = (int(x) * self.dtype.itemsize for x in (self.offsets[record : record + 2] if hasattr(self, "offsets") else self.entries("offsets", record, 2)))
        return np.frombuffer(self.read(self.payload, a, b - a), self.dtype)


class Reader:
    """Keyed access to a folder of shards (for clients outside Spark); the last shards used stay open."""

    def __init__(self, manifest_rows: list, folder: str, id_bytes: int):
        rows = sorted((r["first_key"], r["last_key"], r["name"]) for r in manifest_rows if r["first_key"] is not None)
        self.last = [r[1] for r in rows]
        self.rows, self.folder, self.id_bytes = rows, folder, id_bytes
        self.open: OrderedDict[str, Shard] = OrderedDict()

    def shard(self, name: str) -> Shard:
        if name not in self.open:
            if len(self.open) >= OPEN:
                self.open.popitem(last=False)
            self.open[name] = Shard(self.folder, name, self.id_bytes)
        self.open.move_to_end(name)
        return self.open[name]

    def get(self, key: int) -> list[np.ndarray]:
        """Ids of the documents with this key, in file order (a key of very many can go on in the next shard)."""
        out = []
        for first, _, name in self.rows[bisect.bisect_left(self.last, key) :]:
            if first > key:
                break
            s = self.shard(name)
            out += [s.ids(r) for r in s.records(key)]
        return out


def write_shards(
    spark: SparkSession, docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_bytes: int,
    doc_id: str = "doc_id", text: str = "text", shards: int | None = None,
) -> DataFrame:
    """Write ``docs`` under ``folder``; one manifest row for each shard."""
    prepare(spark)
    n = shards
    if n is None:
        size = docs.agg(F.sum(F.octet_length(text)).alias("s")).first()["s"] or 0
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // SHARD_BYTES))
    order = [F.col("doc_id"), F.xxhash64("text")]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        shard, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        enc, name = encoder(tokenizer_path, end_id, f"<u{id_bytes}"), f"part-{shard:05d}"
        fs, path = filesystem(folder)
        own = f"{path}/_attempt-{attempt}"
        keys, valid, lengths, out = [], [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                fs.create_dir(own, recursive=True)
                out = fs.open_output_stream(f"{own}/{name}.ids", buffer_size=1 << 20)
            k = batch.column(0)
            valid.append(np.array(k.is_valid()))
            keys.append(np.array(k.fill_null(0)))
            for raw in enc.encode_batch(batch.column(1).to_pylist()):
                lengths.append(len(raw) // id_bytes)
                out.write(raw)
        if out is None:
            return
        out.close()
        keys, valid = np.concatenate(keys).astype(np.int64), np.concatenate(valid)
        with fs.open_output_stream(f"{own}/{name}.mph") as f:
            f.write(build_index(keys, valid, np.array(lengths, np.int64)))
        for kind in ("ids", "mph"):
            fs.move(f"{own}/{name}.{kind}", f"{path}/{name}.{kind}")
        fs.delete_dir(own)
        some = keys[valid]
        row = [shard, name, len(lengths), int(sum(lengths)), int(some[0]) if len(some) else None, int(some[-1]) if len(some) else None]
        kinds = [pa.int64(), pa.string(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(row, kinds, strict=True)],
            names=[c.split()[0] for c in MANIFEST.split(", ")],
        )

    return materialize(spark, rows.mapInArrow(run, MANIFEST), "token-manifest")


def read_shards(spark: SparkSession, manifest: DataFrame, folder: str, id_bytes: int) -> DataFrame:
    """Every document's place and checksum, looked up by key and read from the files.

    Only the manifest (one row for each shard) passes through the driver, for
    the running total of ids.
    """
    prepare(spark)
    shards, base, todo = sorted(manifest.collect(), key=lambda r: r["shard"]), 0, []
    for r in shards:
        todo.append((r["name"], base))
        base += r["n_ids"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for name, first_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = Shard(folder, name, id_bytes).load()
                keys = np.unique(s.keys[s.valid])
                first, count = s.find(keys)
                if not (count > 0).all() or count.sum() != s.valid.sum():
                    raise ValueError(f"{name}: index does not cover its keys")
                null = np.count_nonzero(~s.valid)  # listed ahead of the keyed records
                record = np.concatenate([np.arange(null), *[np.arange(a, a + c) for a, c in zip(first, count, strict=True)]]) if len(keys) else np.arange(null)
                record = record.astype(np.int64)
                crc = [zlib.crc32(s.ids(r).astype("<u4").tobytes()) for r in record.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.keys[record], pa.int64(), mask=~s.valid[record]), pa.array(first_id + s.offsets[record]),
                     pa.array(np.diff(s.offsets)[record]), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    places = spark.createDataFrame(todo, "name string, base long").repartition(max(1, len(todo)))
    return places.mapInArrow(run, RECORDS)


def lookup(manifest_rows: list, folder: str, id_bytes: int, key: int) -> list[np.ndarray]:
    """One look-up with a reader of its own."""
    return Reader(manifest_rows, folder, id_bytes).get(key)
