"""Language identification: averaged hashed subword embeddings, linear softmax.

Subwords are the 2- to 4-byte windows of the lower-cased UTF-8 text in which
every ASCII non-letter is a space (so word edges are part of a subword).  They
are hashed to buckets, each with an embedding; a text is the average of its
embeddings, followed by a linear softmax.  Trained by stochastic gradient
descent in numpy on a bounded sample; a temperature fitted on held-back
sample texts calibrates the score, and predictions below ``min_score`` (the
lowest score from which held-back predictions reach the wanted precision) are
marked rejected.

For prediction the linear layer is folded into the buckets (average and
linear map commute), so scoring whole texts is one table look-up and sum for
each subword.

Defined results: null or letterless text is ``und`` with score 0; texts of any
length are read whole, in pieces; repeated rows get equal results; without a
labelled sample every text is ``und``; of equal probabilities the alphabetically first
language wins; at most ``max_langs`` languages are learned (the most frequent, by name among
equals); an empty table gives an empty result; only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare

UND = "und"
#: ASCII non-letters become spaces.
_FOLD = bytes(b if chr(b).isalpha() or b >= 128 else 32 for b in range(256))
#: Longest stretch of bytes scored at once.
STRETCH = 1 << 18


@dataclass(frozen=True)
class Training:
    """Bounds and settings of the fit (the sample is the only bounded part)."""

    per_lang: int = 1500  #: documents sampled for each language
    total: int = 24_000  #: documents sampled in all: fewer for each language where there are many
    max_langs: int = 256  #: languages learned, most frequent first
    max_chars: int = 4000  #: window taken from a sampled document
    bits: int = 16
    dim: int = 16
    epochs: int = 5
    rate: float = 0.5
    seed: int = 7
    precision: float = 0.999  #: of the accepted held-back predictions


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (buckets, languages): embedding times linear layer
    bias: np.ndarray
    temperature: float
    min_score: float
    bits: int


def fold(text: str) -> bytes:
    return b" " + text.lower().encode("utf-8", "replace").translate(_FOLD) + b" "


def buckets(raw: np.ndarray, bits: int) -> list[np.ndarray]:
    """Bucket of every 2-, 3- and 4-byte window (window n starts at each byte that has n left)."""
    b = raw.astype(np.uint32)
    x, out = b[:-1] | (b[1:] << np.uint32(8)), []
    for n in (2, 3, 4):
        if n > 2:
            x = x[:-1] | (b[n - 1 :] << np.uint32(8 * (n - 1)))
        out.append(((x * np.uint32(2654435761) + np.uint32(n * 40503)) * np.uint32(2246822519)) >> np.uint32(32 - bits))
    return out


def scores(model: Model, texts: list[str]) -> np.ndarray:
    """Calibrated probabilities (texts x languages), each over the whole text."""
    sums, counts = np.zeros((len(texts), len(model.langs))), np.zeros(len(texts))
    group: list[tuple[int, bytes, int]] = []  # text, bytes, window starts that count

    def flush() -> None:
        raw = np.frombuffer(b"".join(p for _, p, _ in group), np.uint8)
        ends = np.cumsum([len(p) for _, p, _ in group])
        starts = ends - [len(p) for _, p, _ in group]
        for n, idx in zip((2, 3, 4), buckets(raw, model.bits), strict=True):
            got = model.table[idx]
            for (k, _, own), a, z in zip(group, starts, ends, strict=True):
                z = min(z - n + 1, a + own)  # windows do not reach into the next text
                if z > a:
                    sums[k] += got[a:z].sum(axis=0, dtype=np.float64)
                    counts[k] += z - a
        group.clear()

    size = 0
    for k, t in enumerate(texts):
        raw = fold(t)
        for at in range(0, max(len(raw) - 3, 1), STRETCH):
            piece = raw[at : at + STRETCH + 3]  # windows that start here end here
            group.append((k, piece, STRETCH if at + STRETCH < len(raw) - 3 else len(piece)))
            size += len(piece)
            if size >= STRETCH:
                flush()
                size = 0
    if group:
        flush()
    z = (sums / np.maximum(counts, 1)[:, None] + model.bias) / model.temperature
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit(rows: list[tuple[str, str]], cfg: Training = Training()) -> Model | None:
    """Train on (text, language) pairs."""
    langs = sorted({y for _, y in rows})
    if not langs:
        return None
    rng = np.random.default_rng(cfg.seed)
    data = []
    for t, y in rows:
        raw = np.frombuffer(fold(t), np.uint8)
        data.append((raw, langs.index(y)))
    order = rng.permutation(len(data))
    n_held = len(data) // 5
    held, train = order[:n_held], order[n_held:]
    emb = rng.uniform(-1 / cfg.dim, 1 / cfg.dim, (1 << cfg.bits, cfg.dim)).astype(np.float32)
    lin, bias = np.zeros((cfg.dim, len(langs)), np.float32), np.zeros(len(langs), np.float32)

    def crop(raw: np.ndarray) -> np.ndarray:
        """Random stretches, so that short texts are learned too."""
        n = int(min(len(raw), 40 * 2 ** rng.uniform(0, 6)))
        a = int(rng.integers(0, len(raw) - n + 1))
        return raw[a : a + n]

    step, steps = 0, max(1, cfg.epochs * len(train))
    for _ in range(cfg.epochs):
        for k in rng.permutation(train):
            raw, y = data[k]
            idx = np.concatenate(buckets(crop(raw), cfg.bits))
            rate = cfg.rate * (1 - step / steps)
            step += 1
            if not len(idx):
                continue
            h = emb[idx].mean(axis=0)
            z = h @ lin + bias
            p = np.exp(z - z.max())
            g = p / p.sum()
            g[y] -= 1
            back = lin @ g
            lin -= rate * np.outer(h, g)
            bias -= 0.1 * rate * g
            # every subword's share of the average gets its share of the gradient, scaled up as counts are sparse
            np.subtract.at(emb, idx, (rate * 8 / len(idx)) * back)
    model = Model(langs, (emb @ lin).astype(np.float32), bias.astype(np.float64), 1.0, 0.0, cfg.bits)
    if n_held:
        texts, truth = [rows[k][0] for k in held], np.array([data[k][1] for k in held])
        base = np.log(np.maximum(scores(model, texts), 1e-30))

        def nll(t: float) -> float:
            z = base / t
            z = z - z.max(axis=1, keepdims=True)
            return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]))

        model.temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=nll)
        p = scores(model, texts)
        top, wrong = p.max(axis=1), p.argmax(axis=1) != truth
        by_score = np.argsort(-top, kind="stable")
        errors = np.cumsum(wrong[by_score])
        good = np.flatnonzero(errors <= (1 - cfg.precision) * np.arange(1, len(errors) + 1))
        # every held-back text passes if all of them together are precise enough
        if len(good) and good[-1] < len(errors) - 1:
            model.min_score = float(top[by_score[good[-1]]])
    return model


def sample(docs: DataFrame, cfg: Training, doc_id: str, text: str, lang: str, usable: Column) -> list[tuple[str, str]]:
    """About ``per_lang`` labelled texts of each language, ``total`` in all, picked by a hash of the id.

    The share to pick comes from counts over all rows, so no group is gathered
    anywhere; the final limit only guards the documented bound.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & usable)
    counts = rows.groupBy(F.col(lang).alias("l")).count().orderBy(F.desc("count"), "l").limit(cfg.max_langs).collect()
    if not counts:
        return []
    each = min(cfg.per_lang, cfg.total // len(counts))
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col(lang) == r["l"], F.lit(each / r["count"])).otherwise(share)
    key = F.xxhash64(F.lit(cfg.seed), F.col(doc_id))
    at = F.pmod(F.shiftright(key, 7), F.greatest(F.length(text) - cfg.max_chars, F.lit(1))) + 1
    got = (
        rows.where(F.pmod(key, F.lit(1 << 24)) < share * (1 << 24))
        .select(F.col(doc_id).alias("i"), F.substring(F.col(text), at, F.lit(cfg.max_chars)).alias("t"), F.col(lang).alias("l"))
        .limit(2 * each * len(counts))
        .collect()
    )
    return [(r["t"], r["l"]) for r in sorted(got, key=lambda r: (r["i"] is None, r["i"], r["t"], r["l"]))]


def identify(
    spark: SparkSession, docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score, accepted`` for every document, from its text alone."""
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        m = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ok = [m is not None and bool(t) and any(c.isalpha() for c in t) for t in texts]
            pred, score = [UND] * len(texts), [0.0] * len(texts)
            if any(ok):
                p = scores(m, [t for t, o in zip(texts, ok, strict=True) if o])
                best = iter(zip(p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True))
                for k, o in enumerate(ok):
                    if o:
                        b, s = next(best)
                        pred[k], score[k] = m.langs[b], min(1.0, s)
            accepted = [o and s >= m.min_score for o, s in zip(ok, score, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "accepted"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, accepted boolean")
