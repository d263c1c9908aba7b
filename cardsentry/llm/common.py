"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: A table is broadcast only when its measured row count stays within this
#: many narrow rows (a few MB); beyond it every operator takes a shuffle join.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and reread it.

    Cuts the lineage with files every executor can reach, so a lost executor
    never forces the work before this point to run again.
    """
    path = scratch_path(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fitting(df: DataFrame, rows: int, each: int = 10_000) -> DataFrame:
    """``df`` in as many partitions as so many (measured) rows need, one a core at least; never more than it has."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def prepare(spark: SparkSession, rows: int = 512, mb: int = 16) -> None:
    """Ready the session for Python tasks.

    Arrow batches stay small, because texts can be very long, and workers look
    for this package where the driver found it (a cluster has it installed
    there or ships it with ``--py-files``).
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``.

    Binds the value to a lambda variable, so an expensive array is not
    computed again for every element of a nested higher-order function.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fresh(name: str) -> str:
    """A column name that cannot clash with a column of the input."""
    return f"_{name}_{uuid.uuid4().hex[:8]}"


def with_row_key(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, bool]:
    """Add ``key``, which tells rows apart: the id where ids are unique, else a hash of id and text.

    Rows that repeat in full share a key.  Also says whether the ids are unique.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("i"))
    unique = not own.groupBy("i").count().where("count > 1 or i is null").limit(1).count()
    return docs.withColumn(key, F.col(doc_id).cast("long") if unique else F.xxhash64(doc_id, text)), unique


def without(spark: SparkSession, docs: DataFrame, key: str, gone: DataFrame, label: str) -> DataFrame:
    """``docs`` without the rows whose ``key`` is in the one-column table ``gone``.

    The keys are broadcast while measured few; beyond that, a shuffle join.
    """
    name = fresh("gone")
    gone = materialize(spark, gone.toDF(name).distinct(), label)
    if gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs[key] == gone[name], "left_anti")


def doc_crc(col: Column) -> Column:
    """crc32 of an id as decimal text; defines the fixed folds."""
    return F.crc32(col.cast("string").cast("binary"))


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    """The process's tokenizer; special-token strings in a text are plain text."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


@functools.lru_cache(maxsize=4)
def encoder(path: str, end_id: int, dtype: str, memo_size: int = 1_000_000) -> "IdEncoder":
    """One encoder, with its memo, for each Python worker."""
    return IdEncoder(path, end_id, dtype, memo_size)


class IdEncoder:
    """Whole texts -> token ids as little-endian unsigned integers.

    Both vocabularies cut a text into words before merging and merge within a
    word only, so each distinct word goes to the tokenizers library once and
    its ids are reused.  This covers texts in plain Latin letters; a text with
    any other character is handed to the library whole.  Unseen words are
    encoded many at a time, joined by a separator that comes back as a known
    boundary; if the boundaries do not add up, each word is encoded alone.

    The memo stops growing at ``memo_size`` entries, which bounds memory and
    changes no result.
    """

    # The word patterns of the two vocabularies over this alphabet.
    LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
    SPACED = rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+"
    UNSPACED = rf"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+"

    def __init__(self, path: str, end_id: int, dtype: str = "<u4", memo_size: int = 1_000_000):
        import re

        import numpy as np

        self._np = np
        self.tok = tokenizer(path)
        self.dtype = np.dtype(dtype)
        self.end = np.array([end_id], self.dtype).tobytes()
        self.memo_size = memo_size
        self.memo: dict[str, bytes] = {}
        self.other = re.compile(rf"[^\n\x20-\x7e{self.LETTERS}]")
        one = self.tok.encode("\n", add_special_tokens=False).ids
        #: Id of a lone line feed; None if the vocabulary drops white space.
        self.newline = one[0] if one else None
        self.words = re.compile(self.UNSPACED if self.newline is None else self.SPACED).findall
        if self.newline is None:
            ends = [i for w, i in self.tok.get_vocab().items() if w.endswith("</w>")]
            self.is_end = np.zeros(self.tok.get_vocab_size() + 1, bool)
            self.is_end[ends] = True

    def _alone(self, pieces: list[str]) -> list[bytes]:
        out = self.tok.encode_batch_fast(pieces, add_special_tokens=False)
        return [self._np.array(e.ids, self.dtype).tobytes() for e in out]

    def _joined(self, words: list[str]) -> list[bytes]:
        """Ids of words made of letters (one leading space allowed)."""
        np, out, size = self._np, [], self.dtype.itemsize
        joint = " " if self.newline is None else "\n"
        groups = [words[i : i + 200] for i in range(0, len(words), 200)]
        coded = self.tok.encode_batch_fast([joint.join(g) for g in groups], add_special_tokens=False)
        for part, e in zip(groups, coded, strict=True):
            ids = np.array(e.ids, self.dtype)
            if self.newline is None:
                stop = np.flatnonzero(self.is_end[ids]) + 1
                start = np.concatenate([[0], stop[:-1]])
            else:
                cut = np.flatnonzero(ids == self.newline)
                start, stop = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(ids)]])
            if len(stop) != len(part):
                out += self._alone(part)
                continue
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip((start * size).tolist(), (stop * size).tolist(), strict=True)]
        return out

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Bytes of each text's ids and the end id (null text: the end id alone)."""
        out, split, whole = [b""] * len(texts), {}, []
        known, unseen = self.memo.get, set()
        for k, t in enumerate(texts):
            if t and self.other.search(t):
                whole.append(k)
            elif t:
                words = self.words(t.lower() if self.newline is None else t)
                ids = [*map(known, words)]
                if None in ids:
                    split[k] = words
                    unseen.update([w for w, raw in zip(words, ids, strict=True) if raw is None])
                else:
                    out[k] = b"".join(ids)
        for k, raw in zip(whole, self._alone([texts[k] for k in whole]) if whole else [], strict=True):
            out[k] = raw
        plain = [w for w in unseen if w[-1].isalpha() and w[0] != "'"]
        other = list(unseen.difference(plain))
        got = dict(zip(plain + other, self._joined(plain) + self._alone(other), strict=True))
        if len(self.memo) + len(got) <= self.memo_size:
            self.memo.update(got)
            got = {}
        for k, words in split.items():
            if got:
                out[k] = b"".join([self.memo[w] if w in self.memo else got[w] for w in words])
            else:
                out[k] = b"".join(map(self.memo.__getitem__, words))
        return [x + self.end for x in out]
