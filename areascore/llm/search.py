"""Ranked lexical search: item vocabulary tiles times document impact tiles, exact in float64, tie-safe top-k of each tile."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areascore.llm.common import running, settled, stored

#: Places of each item.
TOP = 20
#: UTF-8 bytes of the items that are searched together: their words go to every worker.
ITEM_BYTES = 2 << 20
#: Items, documents and words of a tile.
ITEMS, DOCS, WORDS = 64, 1024, 4096
#: Impacts are below this. A row of an item tile sums to at most EXACT / IMPACT, so sums of products stay exact.
IMPACT, EXACT = 1_000_000, 2**53
#: Constants of the score. Fixed values.
SCALE, TF_SCALE, K, B, PERCENT = 1_000_000_000, 1000, 12, 25, 100
#: Lists that an item's best are merged from before they are merged whole.
SALTS = 64

# In UTF-8, all that isn't a control character, sign or space of ASCII.
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def terms(text: bytes) -> list[bytes]:
    """Terms of UTF-8 ``text``; of bytes, only A-Z have another lower case."""
    return _TERM.findall(text.lower())


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def forward(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document: ``doc_id``, ``n`` (terms with repeats), and its terms of ``vocabulary`` by number (``terms``, ``tf``)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the terms of at most ITEM_BYTES and one item

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            n, ids, tf, offsets = [], [], [], [0]
            for raw in batch.column(1).to_pylist():
                found = terms(raw)
                n.append(len(found))
                counts = Counter(map(number, found))
                counts.pop(None, None)
                ids += counts.keys()
                tf += counts.values()
                offsets.append(len(ids))
            at = pa.array(offsets, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(v, pa.int32())) for v in (ids, tf)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "tf"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<int>")


class ItemTile:
    """Items with their words renumbered: matrices of weights whose rows sum to at most EXACT / IMPACT."""

    def __init__(self, items: list[Counter], weights: np.ndarray, exact: int = EXACT):
        cap = exact // IMPACT
        used = sorted({t for c in items for t in c})
        self.words = np.array(used, np.int32)
        place = {t: i for i, t in enumerate(used)}
        full = np.zeros((len(items), len(used)), np.int64)
        for i, c in enumerate(items):
            for t, q in c.items():
                full[i, place[t]] = q * weights[t]
        self.parts = []  # (columns, matrix); a column that is too heavy for one part goes on in the next
        columns, values, sums = [], [], np.zeros(len(items), np.int64)
        for j in range(len(used)):
            left = full[:, j].copy()
            while left.any():
                if len(columns) == WORDS or (np.minimum(left, cap) + sums > cap).any() and columns:
                    self._add(columns, values)
                    columns, values, sums = [], [], np.zeros(len(items), np.int64)
                now = np.minimum(left, cap)
                columns.append(j)
                values.append(now)
                sums += now
                left -= now
        if columns:
            self._add(columns, values)
        self.rows = len(items)

    def _add(self, columns, values):
        self.parts.append((np.array(columns), np.array(values, np.float64).T.copy()))

    def scores(self, place: np.ndarray, words: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n: int) -> np.ndarray:
        """Items times ``n`` documents, whose postings are ``words``, ``docs`` and ``impacts``; ``place`` is room for a lookup."""
        place[self.words] = np.arange(len(self.words))
        column = place[words]
        place[self.words] = -1
        own = np.flatnonzero(column >= 0)
        total = np.zeros((self.rows, n), np.int64)
        for columns, matrix in self.parts:
            at = np.full(len(self.words), -1)
            at[columns] = np.arange(len(columns))
            here = at[column[own]]
            met = own[here >= 0]
            dense = np.zeros((len(columns), n))
            dense[here[here >= 0], docs[met]] = impacts[met]
            total += (matrix @ dense).astype(np.int64)
        return total


class Best:
    """The best documents of some items so far: highest score, then least key, keys that are null last."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.ones(items, np.int64)  # a score below ``least`` can't be among the best
        self.item, self.score, self.doc, self.null = (np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool))

    def add(self, first: int, scores: np.ndarray, docs: np.ndarray, null: np.ndarray) -> None:
        rows = slice(first, first + len(scores))
        if scores.shape[1] >= self.top:  # as many documents of this tile reach their nth best, so it bounds the best from below
            nth = np.partition(scores, scores.shape[1] - self.top, axis=1)[:, scores.shape[1] - self.top]
            self.least[rows] = np.maximum(self.least[rows], nth)
        item, at = np.nonzero(scores >= self.least[rows, None])
        self.item = np.concatenate([self.item, item + first])
        self.score = np.concatenate([self.score, scores[item, at]])
        self.doc = np.concatenate([self.doc, docs[at]])
        self.null = np.concatenate([self.null, null[at]])

    def prune(self) -> None:
        by = np.lexsort((self.doc, self.null, -self.score, self.item))
        item = self.item[by]
        starts = np.searchsorted(item, item)
        by = by[np.arange(len(by)) - starts < self.top]
        self.item, self.score, self.doc, self.null = (v[by] for v in (self.item, self.score, self.doc, self.null))
        last = np.flatnonzero(np.bincount(self.item, minlength=len(self.least)) == self.top)
        ends = np.searchsorted(self.item, last, "right") - 1
        self.least[last] = np.maximum(self.least[last], self.score[ends])


def _ranked(tiles, n_docs: int, n_terms: int, n_words: int, top: int):
    """For rows of ``forward``: item number, score and document of the best that a task has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = tiles.value
        place = np.full(n_words, -1, np.int32)
        best = Best(sum(t.rows for t in made), top)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                part = batch.slice(at, DOCS)
                null = part.column(0).is_null().to_numpy(zero_copy_only=False)
                docs = part.column(0).fill_null(0).to_numpy()
                m = PERCENT - B + B * part.column(1).to_numpy() * n_docs // max(n_terms, 1)
                sizes = part.column(2).value_lengths().to_numpy()
                words, tf = (part.column(i).flatten().to_numpy().astype(t) for i, t in ((2, np.int32), (3, np.int64)))
                of = np.repeat(np.arange(len(docs)), sizes)
                impacts = (SCALE * tf // (TF_SCALE * tf + K * m[of])).astype(np.float64)
                first = 0
                for tile in made:
                    best.add(first, tile.scores(place, words, of, impacts, len(docs)), docs, null)
                    first += tile.rows
                best.prune()
        columns = [pa.array(best.item), pa.array(best.score), pa.array(best.doc, mask=best.null)]
        yield pa.RecordBatch.from_arrays(columns, names=["nth", "score", "doc_id"])

    return run


def _block(numbered: DataFrame, block: int) -> list[tuple[int, Counter]]:
    """Items of one block, with their terms counted: at most ITEM_BYTES of text and one item."""
    rows = numbered.filter(F.col("_block") == block).orderBy("row_before").select("item_id", "text").collect()
    return [(r["item_id"], Counter(terms(bytes(r["text"])))) for r in rows]


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    top: int = TOP, item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """For each row of ``items`` its ``top`` best documents: ``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` (above 0).

    All items meet all documents in blocks: items of ``item_bytes`` of text at a time, their vocabulary broadcast; the
    documents' counts of that vocabulary are written once, then read in tiles and multiplied. A
    task keeps the best of each item; equal scores go by ascending key, null keys last. Lists of the tasks are
    merged in two steps, so that no task sees all of an item's. Null texts have no terms; a document without
    terms counts nowhere; items without terms get no rows; repeated documents rank on their own and repeated items get rows each;
    whole texts of any length; empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    given = items.select(F.col(item_key).cast("long").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).cast("binary").alias("text"))
    sized = running(given, [F.col("item_id"), F.col("text")], {"bytes": F.octet_length("text").cast("long")})
    numbered = settled(sized.withColumn("_block", F.floor(F.col("bytes_before") / item_bytes)))
    whole = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    found = [_search(whole, block, top) for (b,) in sorted(map(tuple, numbered.select("_block").distinct().collect())) if (block := _block(numbered, b))]
    none = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, found) if found else none


def _search(docs: DataFrame, items: list[tuple[int, Counter]], top: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in items for t in c}))}
    index = stored(forward(docs, vocabulary), "forward")
    n_docs, n_terms = index.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = dict(map(tuple, index.select(F.explode("terms").alias("t")).groupBy("t").count().collect()))  # the vocabulary's
    weights = np.array([weight(n_docs, df.get(i, 0)) for i in range(len(vocabulary))], np.int64)
    counted = [Counter({vocabulary[t]: q for t, q in c.items()}) for _, c in items]
    tiles = [ItemTile(counted[i : i + ITEMS], weights) for i in range(0, len(counted), ITEMS)]
    shared = spark.sparkContext.broadcast(tiles)
    ranked = index.filter(F.size("terms") > 0).mapInArrow(_ranked(shared, n_docs, n_terms, len(vocabulary), top), "nth long, score long, doc_id long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = ranked.withColumn("_salt", F.spark_partition_id() % SALTS)
    for keys in (["nth", "_salt"], ["nth"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    ids = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(items)], "nth long, item_id long")
    return salted.join(ids, "nth").select("item_id", "rank", "doc_id", "score")
