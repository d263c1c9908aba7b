"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; learned filters of ``WIDTH`` bytes slide over the whole
document; their responses are max-pooled in overlapping chunks (``2 * HALF``
bytes, moved by ``HALF``); the chunks' pooled vectors are combined by mean,
maximum and minimum and a small dense layer gives one probability that the
document is of good quality.

Embedding and filters fold into one table for each pair of filter positions,
so scoring is ``WIDTH / 2`` look-ups a byte.  Long texts are scored in
stretches that overlap by the filter width: memory is bounded and every byte
counts.

Trained by Adam on a bounded, class-balanced sample of labelled rows; the
logit is shifted back to the labels' true odds.

Defined results: null and empty texts are one chunk of padding and get a
score; repeated label rows count as good only if none says bad; without
labels of both classes every score is the share of good labels (0.5 without
any); repeated rows get equal results; texts of any length are scored whole; a score equal to a
limit reaches it; an empty table gives an empty result; other columns pass through, and the score goes
to a column that the caller names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import prepare

WIDTH, HALF = 6, 128
#: Half-chunks scored at once.
STRETCH = 512


@dataclass(frozen=True)
class Training:
    """Bounds and settings of the fit (the sample is the only bounded part)."""

    per_class: int = 1200  #: labelled documents sampled for each class
    max_chars: int = 16_000  #: window taken from a sampled document
    crop: int = 4096  #: bytes of it seen in one step
    filters: int = 24
    dim: int = 8
    hidden: int = 16
    epochs: int = 8
    batch: int = 24
    rate: float = 0.01
    seed: int = 11


@dataclass
class Model:
    emb: np.ndarray  # (256 + 1, dim); the last row is padding
    conv: np.ndarray  # (WIDTH, dim, filters)
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    shift: float = 0.0
    _pairs: list | None = None

    def tables(self) -> np.ndarray:
        """(WIDTH, 257, filters): response of each filter position to each byte."""
        return np.einsum("vd,kdf->kvf", self.emb, self.conv).astype(np.float32)

    def pairs(self) -> list[np.ndarray]:
        if self._pairs is None:
            t = self.tables()
            self._pairs = [
                (t[k][:, None, :] + t[k + 1][None, :, :]).reshape(257 * 257, -1) for k in range(0, WIDTH, 2)
            ]
        return self._pairs


def padded(raw: bytes) -> np.ndarray:
    """Bytes as symbols, filled up to whole half-chunks (two at least), and the filter's overhang."""
    n = max(2, -(-len(raw) // HALF))
    out = np.full(n * HALF + WIDTH - 1, 256, np.int32)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out


def pooled_halves(model: Model, sym: np.ndarray) -> np.ndarray:
    """Maximum of each filter over the positions of each half-chunk."""
    n, pairs, out = (len(sym) - WIDTH + 1) // HALF, model.pairs(), []
    for at in range(0, n, STRETCH):
        m = min(STRETCH, n - at) * HALF
        s = sym[at * HALF : at * HALF + m + WIDTH - 1]
        two = s[:-1] * 257 + s[1:]
        r = pairs[0][two[:m]]
        for k in range(1, WIDTH // 2):
            r += pairs[k][two[2 * k : 2 * k + m]]
        out.append(r.reshape(-1, HALF, r.shape[1]).max(axis=1))
    return np.concatenate(out)


def combine(chunks: np.ndarray) -> np.ndarray:
    c = np.maximum(chunks, 0)
    return np.concatenate([c.mean(axis=0), c.max(axis=0), c.min(axis=0)])


def score(model: Model | float, text: str | None) -> float:
    """Probability of good quality, from the whole text."""
    if not isinstance(model, Model):
        return float(model)
    halves = pooled_halves(model, padded((text or "").encode("utf-8", "replace")))
    v = combine(np.maximum(halves[:-1], halves[1:]))
    z = float(np.maximum(v @ model.w1 + model.b1, 0) @ model.w2 + model.b2 + model.shift)
    return float(1 / (1 + np.exp(-max(-40.0, min(40.0, z)))))


def fit(rows: list[tuple[str, int]], good_share: float, cfg: Training = Training()) -> Model | float:
    """Train on (text, 0/1) pairs; ``good_share`` is the true share of 1s."""
    labels = np.array([y for _, y in rows], int)
    if len(set(labels.tolist())) < 2:
        return good_share
    rng = np.random.default_rng(cfg.seed)
    f, d = cfg.filters, cfg.dim
    p = {
        "emb": rng.normal(0, 0.5, (257, d)), "conv": rng.normal(0, 0.3, (WIDTH, d, f)),
        "w1": rng.normal(0, 0.2, (3 * f, cfg.hidden)), "b1": np.zeros(cfg.hidden),
        "w2": rng.normal(0, 0.3, cfg.hidden), "b2": np.zeros(1),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    raws = [t.encode("utf-8", "replace") for t, _ in rows]
    by_class = [np.flatnonzero(labels == c) for c in (0, 1)]
    steps = cfg.epochs * -(-len(rows) // cfg.batch)
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(c, cfg.batch // 2) for c in by_class])
        t = np.einsum("vd,kdf->kvf", p["emb"], p["conv"])
        g = {k: np.zeros_like(v) for k, v in p.items()}
        dt = np.zeros_like(t)
        for k in pick:
            raw = raws[k]
            a = int(rng.integers(0, max(1, len(raw) - cfg.crop + 1)))
            sym = padded(raw[a : a + cfg.crop])
            n = (len(sym) - WIDTH + 1) // HALF
            r = t[0][sym[: n * HALF]]
            for j in range(1, WIDTH):
                r += t[j][sym[j : j + n * HALF]]
            r = r.reshape(n, HALF, f)
            best = r.argmax(axis=1)  # (half-chunks, filters)
            top = np.take_along_axis(r, best[:, None, :], axis=1)[:, 0]
            right = top[1:] > top[:-1]  # which half of each chunk holds the maximum
            chunk = np.where(right, top[1:], top[:-1])
            v = np.maximum(chunk, 0)
            hi, lo = v.argmax(axis=0), v.argmin(axis=0)
            x = np.concatenate([v.mean(axis=0), v.max(axis=0), v.min(axis=0)])
            h = np.maximum(x @ p["w1"] + p["b1"], 0)
            z = float(h @ p["w2"] + p["b2"][0])
            dz = (1 / (1 + np.exp(-max(-40.0, min(40.0, z)))) - labels[k]) / len(pick)
            g["w2"] += dz * h
            g["b2"] += dz
            dh = dz * p["w2"] * (h > 0)
            g["w1"] += np.outer(x, dh)
            g["b1"] += dh
            dx = p["w1"] @ dh
            dv = np.repeat(dx[None, :f] / len(v), len(v), axis=0)
            cols = np.arange(f)
            dv[hi, cols] += dx[f : 2 * f]
            dv[lo, cols] += dx[2 * f :]
            dv *= chunk > 0
            half = np.arange(len(v))[:, None] + right
            pos = (half * HALF + np.take_along_axis(best, half, axis=0)).ravel()
            ff, dd = np.tile(cols, len(v)), dv.ravel()
            for j in range(WIDTH):
                np.add.at(dt[j], (sym[pos + j], ff), dd)
        g["emb"] = np.einsum("kvf,kdf->vd", dt, p["conv"])
        g["conv"] = np.einsum("kvf,vd->kdf", dt, p["emb"])
        rate = cfg.rate * (1 - 0.9 * step / steps)
        for k in p:
            m1[k] = 0.9 * m1[k] + 0.1 * g[k]
            m2[k] = 0.99 * m2[k] + 0.01 * g[k] ** 2
            p[k] -= (rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    odds = np.log(max(good_share, 1e-6) / max(1 - good_share, 1e-6))
    return Model(p["emb"], p["conv"], p["w1"], p["b1"], p["w2"], float(p["b2"][0]), float(odds))


def sample(
    docs: DataFrame, labels: DataFrame, cfg: Training, doc_id: str, text: str, label: str, usable: Column
) -> tuple[list[tuple[str, int]], float]:
    """At most ``per_class`` labelled texts of each class and the true share of good labels.

    Ids are picked from the narrow label table by hash, in the share that the
    class counts over all labels give; their texts follow in one semi-join-like
    pass in which the picked ids (bounded) are broadcast.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & usable)
        .groupBy(F.col(doc_id).alias("label_id")).agg(F.min(label).alias("y"))
    )
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    total = sum(counts.values())
    if not total:
        return [], 0.5
    share = F.when(F.col("y") == 1, F.lit(cfg.per_class / counts.get(1, 1))).otherwise(F.lit(cfg.per_class / counts.get(0, 1)))
    key = F.xxhash64(F.lit(cfg.seed), F.col("label_id"))
    ids = known.where(F.pmod(key, F.lit(1 << 24)) < share * (1 << 24)).limit(4 * cfg.per_class)
    at = F.pmod(F.shiftright(F.xxhash64(F.lit(cfg.seed), F.col(doc_id)), 7), F.greatest(F.length(text) - cfg.max_chars, F.lit(1))) + 1
    texts = docs.select(F.col(doc_id), F.col(text))
    got = (
        texts.join(F.broadcast(ids), texts[doc_id] == ids.label_id)
        .select("label_id", "y", F.substring(F.coalesce(F.col(text), F.lit("")), F.coalesce(at, F.lit(1)), F.lit(cfg.max_chars)).alias("t"))
        .limit(4 * cfg.per_class)
        .collect()
    )
    got.sort(key=lambda r: (r["label_id"], r["t"]))
    return [(r["t"], r["y"]) for r in got], counts.get(1, 0) / total


def with_scores(
    spark: SparkSession, docs: DataFrame, model: Model | float, text: str = "text", into: str = "score"
) -> DataFrame:
    """``docs`` with the probability of good quality, from the text alone."""
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    names = [*docs.columns, into]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        m = shared.value
        for batch in batches:
            # one text at a time: a batch's texts are never all decoded at once
            got = [score(m, x.as_py()) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], names=names)

    schema = StructType([*docs.schema.fields, StructField(into, DoubleType())])
    return docs.mapInArrow(run, schema)
