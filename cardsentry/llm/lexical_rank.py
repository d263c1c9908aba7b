"""Ranked lexical search by dense blocked matrix products.

The items' terms, and no others, make a compact vocabulary.  Items are cut into
tiles, each with the terms of its own items; documents come in tiles of rows.  A
document's impact of each term is an integer below ``SCALE / 1000``, an item's
weight of a term an integer too, so the product of an impact tile and a weight
tile is a matrix product in float64 (BLAS) whose sums are exact while they stay
below 2^53: a tile's terms are taken in groups that keep them there, and the groups
are added in 64-bit integers.

Each task keeps the best rows of an item over its tiles.  Within a tile everything
from the ``k``-th best score on is taken, ties included, and equal scores are
then cut by document id.  Tasks' rows meet in two steps, first by item and
group of tasks, then by item.

The items are a stated query set: they go to every task in blocks of bounded size
(``CELLS`` weights a tile, ``TILES`` tiles a block), each block in passes of its
own.  Of the documents only counts reach the driver: their number, their terms, and
how many hold each term of the block.

Defined results: null texts, and texts without a term, match nothing and are not
counted; every row of the items is ranked by itself, also if ids repeat, and
repeated rows of documents are ranked one by one; equal scores go by ascending
document id, null ids last; texts of any length are read whole; an item without
terms or matches, and an empty table on either side, gives no rows; of the inputs
only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import materialize, prepare

# Fixed values of the score: impact = SCALE * tf / (1000 * tf + 8 * m),
# m = 10 + 90 * length * documents / terms; weight = 1000 * ln((2N + 2) / (2df + 1)).
SCALE = 1_000_000_000
#: Impacts are below this.
MOST_IMPACT = SCALE // 1000
#: Sums of integers are exact in float64 below this.
EXACT = 1 << 53
#: Weights in an item tile, impacts in a document tile.
CELLS = 1 << 20
#: Item tiles in a block.
TILES = 8
#: Groups of tasks whose rows meet first.
GROUPS = 256
#: Id that stands for null in a task: behind every other.
NO_ID = np.iinfo(np.int64).max

#: ASCII capitals become small letters; ASCII outside letters and digits becomes a space.
FOLD = bytes(
    c if c >= 128 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


@dataclass
class Tile:
    """Some items and the terms of these items (numbers of the block's vocabulary)."""

    first: int
    items: list[list[bytes]] = field(default_factory=list)
    terms: set[bytes] = field(default_factory=set)
    columns: np.ndarray | None = None
    weights: np.ndarray | None = None

    def fits(self, terms: list[bytes]) -> bool:
        return (len(self.items) + 1) * len(self.terms.union(terms)) <= CELLS

    def weigh(self, number: dict[bytes, int], weight: np.ndarray) -> None:
        """The dense (terms x items) matrix of weights."""
        self.columns = np.array(sorted(number[t] for t in self.terms), np.int64)
        row = {c: k for k, c in enumerate(self.columns.tolist())}
        self.weights = np.zeros((len(self.columns), len(self.items)))
        for j, terms in enumerate(self.items):
            own = np.array([number[t] for t in terms], np.int64)
            self.weights[[row[c] for c in own.tolist()], j] = weight[own]


@dataclass
class Block:
    ids: list = field(default_factory=list)
    tiles: list[Tile] = field(default_factory=list)

    def vocabulary(self) -> dict[bytes, int]:
        """Numbers of the terms, from 1."""
        return {t: k for k, t in enumerate(sorted(set().union(*(x.terms for x in self.tiles))), 1)}


def item_blocks(rows: Iterable[tuple]) -> Iterator[Block]:
    """The items in blocks of at most ``TILES`` tiles; items without terms are left out."""
    block = Block()
    for item_id, text in rows:
        terms = list(dict.fromkeys(terms_of(text)))
        if not terms:
            continue
        if not block.tiles or not block.tiles[-1].fits(terms):
            if len(block.tiles) == TILES:
                yield block
                block = Block()
            block.tiles.append(Tile(len(block.ids)))
        block.tiles[-1].items.append(terms)
        block.tiles[-1].terms.update(terms)
        block.ids.append(item_id)
    if block.tiles:
        yield block


def counted(docs: DataFrame, number: dict[bytes, int]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each vocabulary term."""
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        get, size = shared.value.get, len(shared.value) + 1
        seen, n, total = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            held: list[int] = []
            for text in batch.column(1).to_pylist():
                if terms := terms_of(text):
                    n, total = n + 1, total + len(terms)
                    held.extend(filter(None, map(get, set(terms))))
            seen += np.bincount(np.array(held, np.int64), minlength=size)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], at])), pa.array(np.concatenate([[n, total], seen[at]]))], names=["term", "n"]
        )

    rows = docs.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found, held = {r["term"]: r["n"] for r in rows}, np.zeros(len(number) + 1, np.int64)
    for k, v in found.items():
        if k > 0:
            held[k] = v
    return found.get(-2, 0), found.get(-1, 0), held


def impacts(texts: list, number: dict[bytes, int], n_docs: int, n_terms: int) -> np.ndarray:
    """The (documents x vocabulary) tile of impacts, as float64 integers; column 0 is empty."""
    width, get = len(number) + 1, number.get
    ids, sizes, m = [], [], []
    for text in texts:
        terms = terms_of(text)
        own = list(filter(None, map(get, terms)))
        ids += own
        sizes.append(len(own))
        m.append(100 - 90 + 90 * len(terms) * n_docs // n_terms)
    key = np.repeat(np.arange(len(texts)) * width, sizes) + np.array(ids, np.int64)
    tf = np.bincount(key, minlength=len(texts) * width)
    cell = np.flatnonzero(tf)
    tf, out = tf[cell], np.zeros(len(texts) * width)
    out[cell] = SCALE * tf // (1000 * tf + 8 * np.array(m, np.int64)[cell // width])
    return out.reshape(len(texts), width)


def product(impact: np.ndarray, tile: Tile, exact: int = EXACT) -> np.ndarray:
    """Exact integer scores (documents x items) of one tile."""
    most = max(1, int(tile.weights.max(initial=0)))
    group = max(1, (exact - 1) // (most * MOST_IMPACT))
    out = np.zeros((len(impact), tile.weights.shape[1]), np.int64)
    for k in range(0, len(tile.columns), group):
        out += (impact[:, tile.columns[k : k + group]] @ tile.weights[k : k + group]).astype(np.int64)
    return out


class Best:
    """The ``k`` best (score, id) of each item so far, ties by id."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)  # scores below this cannot enter
        self.item = self.score = self.doc = np.zeros(0, np.int64)

    def add(self, first: int, scores: np.ndarray, docs: np.ndarray) -> None:
        n, items = scores.shape
        least = self.least[first : first + items]
        if n > self.k:
            least = np.maximum(least, np.partition(scores, n - self.k, axis=0)[n - self.k])
        row, col = np.nonzero(scores >= least)
        if not len(row):
            return
        item = np.concatenate([self.item, col + first])
        score = np.concatenate([self.score, scores[row, col]])
        doc = np.concatenate([self.doc, docs[row]])
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        opens = np.flatnonzero(np.diff(item, prepend=-1))
        rank = np.arange(len(item)) - np.repeat(opens, np.diff(opens, append=len(item)))
        full = np.flatnonzero(rank == self.k - 1)
        self.least[item[full]] = score[full]
        keep = rank < self.k
        self.item, self.score, self.doc = item[keep], score[keep], doc[keep]


def best_of_block(docs: DataFrame, block: Block, k: int, kind) -> DataFrame | None:
    """``query, item_id, doc_id, score, rank`` of one block's items."""
    number = block.vocabulary()
    n_docs, n_terms, held = counted(docs, number)
    if not n_docs:
        return None
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in held.tolist()], np.float64)
    for tile in block.tiles:
        tile.weigh(number, weight)
    shared = docs.sparkSession.sparkContext.broadcast(
        (number, [(t.first, t.columns, t.weights) for t in block.tiles], block.ids, n_docs, n_terms)
    )
    id_type = to_arrow_type(kind)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        number, parts, ids, n_docs, n_terms = shared.value
        tiles = [Tile(f, columns=c, weights=w) for f, c, w in parts]
        best, height = Best(len(ids), k), max(1, CELLS // (len(number) + 1))
        for batch in batches:
            doc = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), height):
                impact = impacts(texts[at : at + height], number, n_docs, n_terms)
                for tile in tiles:
                    best.add(tile.first, product(impact, tile), doc[at : at + height])
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item), pa.array([ids[i] for i in best.item.tolist()], id_type),
             pa.array(best.doc, mask=best.doc == NO_ID), pa.array(best.score)],
            names=["query", "item_id", "doc_id", "score"],
        )

    rows = docs.mapInArrow(run, f"query long, item_id {kind.simpleString()}, doc_id long, score long")
    rows = rows.withColumn("part", F.spark_partition_id() % GROUPS)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for by in (["query", "part"], ["query"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        rows = rows.where(F.col("rank") <= k)
    return rows


def ranked(
    spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items`` its ``k`` best documents with a score above 0."""
    prepare(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    queries = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("binary").alias("text"))
    kind, found = queries.schema["item_id"].dataType, []
    # one partition of items at a time, each handed on in blocks of bounded size
    for block in item_blocks((r["item_id"], bytes(r["text"] or b"")) for r in queries.toLocalIterator()):
        best = best_of_block(rows, block, k, kind)
        if best is not None:
            found.append(materialize(spark, best, "ranked"))
    out = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    for best in found:
        out = out.unionByName(best.select("item_id", "rank", "doc_id", "score"))
    return out
