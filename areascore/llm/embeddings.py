"""Near-duplicate vectors found through their nearest reference points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from areascore.llm.common import blocks, components, same_runs, settled, smallest_reachable

#: How many reference points describe a vector, how many of them a pair shares at least, and by how much their places may differ:
#: the sum of the differences over all points of the two, where a point that one of them lacks comes after its last.
NEAREST, SHARED, FOOTRULE = 8, 3, 54
#: Reference points: one for so many vectors, so that lists stay as long as tables grow; at least, and bytes of all of them at most.
#: They are a bounded sample of the vectors of the most frequent lengths; other lengths take random directions.
PER_PIVOT, LEAST_PIVOTS, PIVOT_BYTES, LENGTHS = 64, 128, 32 << 20, 16
LEAST_COSINE = 0.98
#: Vectors of one list that are compared in one piece, and products that are held at once when points are looked up.
BLOCK, PRODUCTS = 1000, 4_000_000


def usable(vector: str) -> Column:
    """True if the vector has only finite components and one that isn't zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def draw_pivots(nodes: DataFrame, pivots: int | None = None) -> dict[int, np.ndarray]:
    """By number of components, for the most frequent ones: different vectors, drawn by a hash; ``pivots`` of them, or by the
    number of vectors."""
    sizes = nodes.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(LENGTHS).collect()
    found = {}
    for size, n in sizes:
        wanted = pivots or min(max(LEAST_PIVOTS, n // PER_PIVOT), max(LEAST_PIVOTS, PIVOT_BYTES // len(sizes) // (8 * size)))
        rows = nodes.filter(F.size("vector") == size).orderBy(F.xxhash64(F.lit(5), "h1", "h2"), "node").limit(wanted)
        found[size] = unit(np.array([r["vector"] for r in rows.select("vector").collect()]))
    return found


def directions(size: int, pivots: int = LEAST_PIVOTS) -> np.ndarray:
    """Reference points of vectors whose length is rare."""
    return unit(np.random.default_rng(size).normal(size=(pivots, size)))


def nearest_points(rows: np.ndarray, points: np.ndarray, nearest: int) -> np.ndarray:
    """For each row the numbers of its ``nearest`` points, nearest first."""
    k = min(nearest, len(points))
    out = np.empty((len(rows), k), np.int32)
    step = max(1, PRODUCTS // len(points))
    for at in range(0, len(rows), step):
        cosine = rows[at : at + step] @ points.T
        top = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        by = np.lexsort((top, -np.take_along_axis(cosine, top, axis=1)), axis=1)
        out[at : at + step] = np.take_along_axis(top, by, axis=1)
    return out


def _entries(pivots: dict[int, np.ndarray], nearest: int, shared: int, kind: str):
    """Each vector in the inverted lists of the first of its points by number: of k points, two vectors that share s have one in
    common among the first k - s + 1 of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, label, n, vector = (batch.column(i) for i in range(4))
            sizes = np.array([len(v) for v in vector])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                flat = pa.array(at)
                given = np.array(vector.take(flat).to_pylist(), dtype=np.float64)
                points = pivots.get(int(size))
                near = nearest_points(unit(given), directions(int(size)) if points is None else points, nearest)
                posted = np.sort(near, axis=1)[:, : near.shape[1] - min(shared, near.shape[1]) + 1]
                raw, order = (pa.array([r.tobytes() for r in m], pa.binary()) for m in (given.astype(kind), near.astype("<i4")))
                for pivot in posted.T:
                    yield pa.RecordBatch.from_arrays(
                        [node.take(flat), label.take(flat), pa.array(np.full(len(at), size, np.int32)), pa.array(np.ascontiguousarray(pivot)), order, n.take(flat), raw],
                        names=["node", "label", "size", "pivot", "near", "n", "raw"],
                    )

    return run


def alike_orders(near: np.ndarray, pivot: int, shared: int, footrule: int) -> np.ndarray:
    """For each two rows of ordered points: whether they share enough of them, in much the same order, and ``pivot`` is the first by
    number that they share, so that a pair counts in one list."""
    k = near.shape[1]
    points, place = np.unique(near, return_inverse=True)
    place = place.reshape(near.shape)
    weight = np.zeros((len(near), len(points)), np.float32)  # the first counts k, the last 1
    np.put_along_axis(weight, place, np.arange(k, 0, -1, dtype=np.float32)[None], axis=1)
    has = (weight > 0).astype(np.float32)
    before = has[:, points < pivot]
    good = (has @ has.T >= min(shared, k)) & (before @ before.T == 0)
    a, b = np.nonzero(np.triu(good, 1))
    step = max(1, PRODUCTS // weight.shape[1])
    for at in range(0, len(a), step):
        i, j = a[at : at + step], b[at : at + step]
        far = np.abs(weight[i] - weight[j]).sum(axis=1) > footrule
        good[i[far], j[far]] = good[j[far], i[far]] = False
    return good


NAMES = ["label", "size", "pivot", "_i", "_j", "_own", "node", "near", "n", "raw"]


def _links(least: float, shared: int, footrule: int, kind: str):
    def compare(part: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        node, n = part["node"], part["n"]
        order = np.frombuffer(b"".join(part["near"]), "<i4").reshape(len(node), -1)
        good = alike_orders(order, int(part["pivot"][0]), shared, footrule) & (node[:, None] != node[None])
        if part["_i"][0] != part["_j"][0]:
            good &= part["_own"][:, None] != part["_own"][None]
        if not good.any():
            return np.zeros(len(node), np.int64), node
        rows = unit(np.frombuffer(b"".join(part["raw"]), kind).reshape(len(node), -1))
        good &= rows @ rows.T >= least
        root = smallest_reachable(len(node), *np.nonzero(good))
        return good @ n, node[root]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            now = {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(NAMES)}
            if held is not None:
                now = {c: np.concatenate([held[c], now[c]]) for c in NAMES}
            if not len(now["node"]):
                continue
            starts = same_runs(*(now[c] for c in NAMES[:5]))
            held = {c: now[c][starts[-2] :] for c in NAMES}
            yield from out(now, starts[:-1])
        if held is not None:
            yield from out(held, np.array([0, len(held["node"])]))

    def out(rows: dict[str, np.ndarray], starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = []
        for s, e in zip(starts, starts[1:]):
            part = {c: v[s:e] for c, v in rows.items()}
            links, root = compare(part)
            some = (links > 0) | (root != part["node"])
            if some.any():
                found.append((part["node"][some], links[some], root[some]))
        if found:
            arrays = [pa.array(np.concatenate([f[i] for f in found])) for i in range(3)]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "links", "root"])

    return run


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    least: float = LEAST_COSINE, pivots: int | None = None, nearest: int = NEAREST, shared: int = SHARED, block: int = BLOCK,
    footrule: int = FOOTRULE,
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links`` (others linked directly), ``component_id`` (smallest id reachable) and
    ``kept`` (it is that smallest id).

    Vectors link if their labels are equal and their cosine, in double precision, is ``least`` or more. Equal
    vectors are one node with a weight. Each node is described by its ``nearest`` pivots in order, of which there are more as
    the table grows, and stands in the inverted lists of as many of them as it takes for two nodes that share ``shared``
    to meet. In a list, shared pivots are counted and the differences of their places summed up (``footrule`` at most); what
    passes is verified by its cosine. Lists are compared in blocks, each pair counts in one list, and a block
    returns links that span its connected parts, not its pairs.

    Null, zero or empty vectors, vectors with null or non-finite components, null labels and null ids link with
    nothing. Rows with one id but several vectors count as one node. Vectors of different lengths never link.
    An empty table gives no rows; other columns are ignored.
    """
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.col(label).cast("string").alias("label"))
    rows = rows.withColumn("_ok", usable("vector") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    rows = rows.withColumn("h1", F.when(F.col("_ok"), F.xxhash64("label", "vector")))
    rows = rows.withColumn("h2", F.when(F.col("_ok"), F.xxhash64(F.lit(11), "vector", "label")))
    good = rows.filter("_ok")
    nodes = settled(
        good.groupBy("h1", "h2").agg(
            F.min("vec_id").alias("node"), F.count("*").alias("n"), F.first("label").alias("label"),
            F.first("vector").alias("vector"),
        )
    )
    element = getattr(nodes.schema["vector"].dataType, "elementType", None)
    kind = "<f4" if isinstance(element, FloatType) else "<f8"  # as the vectors come; products are in double precision
    entries = nodes.select("node", "label", "n", "vector").mapInArrow(
        _entries(draw_pivots(nodes, pivots), nearest, shared, kind),
        "node long, label string, size int, pivot int, near binary, n long, raw binary",
    )
    dealt = blocks(entries, ["label", "size", "pivot"], "node", block).select(*NAMES)
    links = settled(dealt.mapInArrow(_links(least, shared, footrule, kind), "node long, links long, root long"))
    direct = links.groupBy("node").agg(F.sum("links").alias("_links"))
    reach = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    reach = reach.withColumnRenamed("node", "_node")
    named = nodes.select("h1", "h2", "node", "n").join(direct, "node", "left")
    # written, so that the last join reads two plain exchanges and a frequent vector can be split
    named = settled(named.join(reach, named["node"] == reach["_node"], "left").select(
        F.col("h1").alias("_h1"), F.col("h2").alias("_h2"),
        (F.coalesce("_links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("component_id"),
    ))
    met = rows.select("vec_id", "h1", "h2").join(
        named, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left"
    )
    own = F.coalesce("component_id", "vec_id")
    return met.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"),
    )
