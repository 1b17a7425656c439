"""SimHash near-duplicates through covering masks: no pair within the radius is missed. Similar texts by shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areascore.llm.common import blocks, components, same_runs, settled, smallest_reachable, stored, written
from areascore.sources.tables import drop_folder

BITS, SEED = 64, 42
#: Fingerprints of one bucket that are compared in one piece.
BLOCK = 2000
#: Bands of least hashes and hashes of a band: a pair at similarity s shares a band with 1 - (1 - s^6)^24, 0.9993 at 0.8.
BANDS, ROWS = 24, 6
#: Differing bits up to which two fingerprints of one band are a candidate; at similarity 0.8 they differ in 9.7, with
#: a deviation of 2.9.
WIDE = 24
#: Sets of shingles that are compared in one piece, and shingles that are held as a dense matrix at once.
SETS, COLUMNS = 500, 4096
#: Entries of a bucket from which it is dealt out in parts; buckets are weighed in every SAMPLE-th text. At most one in HOTTEST
#: of all entries is a bucket's bound then, so that there are never more than HOTTEST such buckets.
HOT, SAMPLE, HOTTEST = 200_000, 64, 100_000
#: Sets that are compared with one other in one piece.
STAR = 1000


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64 bits of UTF-8 ``text``: a bit is 1 if more than half of the shingles' hashes have it."""
    words = text.lower().split()  # of bytes: A-Z only, and white space is 32 and 9 to 13
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.array([xxhash.xxh64_intdigest(p, SEED) for p in parts], dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        raw = hashes[at : at + 4096].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as a signed long) of every document; null texts have no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            fps = np.array(found, dtype=np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    given = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    )
    return given.mapInArrow(run, "doc_id long, fp long")


def covering_masks(radius: int = 3, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 masks such that any ``radius`` bits lie outside at least one of them.

    Every bit gets a nonzero vector over GF(2) with radius+1 components; a mask belongs to each nonzero v
    and holds the bits whose vectors have an odd product with v. ``radius`` linear conditions leave a
    nonzero v that is orthogonal to all the differing bits, so that its mask misses them.
    """
    size = 2 ** (radius + 1)
    vector = [1 + i % (size - 1) for i in range(bits)]
    return [
        sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() % 2) for v in range(1, size)
    ]


def _linked(bucket: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (as positions) that span what is connected within each run of equal ``bucket``."""
    a, b = [], []
    step = 1
    same = np.arange(len(fp) - 1)
    while len(same):
        same = same[same + step < len(fp)]
        same = same[bucket[same] == bucket[same + step]]
        # unsigned: of a negative number numpy counts the bits of its absolute value
        near = same[np.bitwise_count((fp[same] ^ fp[same + step]).view(np.uint64)) <= radius]
        a.append(near)
        b.append(near + step)
        if sum(map(len, a)) > 1_000_000:  # what is found so far, as a star
            root = smallest_reachable(len(fp), np.concatenate(a), np.concatenate(b))
            far = np.flatnonzero(root != np.arange(len(fp)))
            a, b = [root[far]], [far]
        step += 1
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    root = smallest_reachable(len(fp), np.concatenate(a), np.concatenate(b))
    far = np.flatnonzero(root != np.arange(len(fp)))
    return root[far], far


def near_links(fps: DataFrame, radius: int = 3, block: int = BLOCK) -> DataFrame:
    """For distinct long fingerprints ``fp``: links ``a``, ``b`` that connect all that differ in at most ``radius`` bits.

    Each fingerprint goes under every covering mask; buckets of one mask and masked value are
    compared in blocks. A block returns links that span its connected parts, at most one a member, not all
    its pairs.
    """
    masks = [m - 2**64 if m >= 2**63 else m for m in covering_masks(radius)]
    under = F.explode(F.array(*(F.struct(F.lit(i).cast("byte").alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for i, m in enumerate(masks))))
    entries = fps.select("fp", under.alias("u")).select("u.mask", "u.value", "fp")
    dealt = blocks(entries, ["mask", "value"], "fp", block).select("mask", "value", "_i", "_j", "fp")

    return dealt.mapInArrow(_spanning(radius), "a long, b long")


def _spanning(radius: int):
    """For rows sorted by four columns of a comparison: links of the fifth, ``fp``, within the radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last key, which may go on
        for batch, last in _with_last(batches):
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
                held = None
            if not len(cols[0]):
                continue
            starts = same_runs(*cols[:4])
            if not last:
                held = [c[starts[-2] :] for c in cols]
                cols = [c[: starts[-2]] for c in cols]
                starts = starts[:-1]
            if len(starts) < 2:
                continue
            bucket = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            fp = cols[4]
            a, b = _linked(bucket, fp, radius)
            yield pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

    return run


def _with_last(batches):
    """Each batch, and whether it is the last."""
    before = None
    for batch in batches:
        if before is not None:
            yield before, False
        before = batch
    if before is not None:
        yield before, True


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3, block: int = BLOCK
) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest key
    reachable over links of at most ``radius`` differing bits.

    Equal fingerprints are one node, so copies cost one row however many there are. A null or wordless text
    has fingerprint zero and links like any other; short texts are one shingle; whole texts count, of
    any length. A null key is passed over in smallest keys (a component of null keys has null). Repeated rows
    come back as often as they are given; an empty table gives no rows; other columns are ignored.
    """
    marked = settled(fingerprints(docs, key, text, shingle))
    nodes = settled(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    reach = components(near_links(nodes.select("fp"), radius, block))
    rooted = nodes.join(reach, nodes["fp"] == reach["node"]).select("fp", "least", "root")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("least"))
    linked = rooted.select("fp", "root").join(smallest, "root").select("fp", F.col("least").alias("linked"))
    # written, so that the last join reads two plain exchanges and a frequent fingerprint can be split
    ids = settled(nodes.join(linked, "fp", "left").select("fp", F.coalesce("linked", "least").alias("component_id")))
    return marked.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """The distinct shingles of UTF-8 ``text`` as sorted 64-bit hashes; words and short texts as in ``fingerprint``."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < shingle:
        parts = {b" ".join(words)}
    else:
        parts = set(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    return np.sort(np.array([xxhash.xxh64_intdigest(p, SEED) for p in parts], dtype=np.uint64))


def _set_fingerprint(hashes: np.ndarray) -> int:
    """As ``fingerprint``, each distinct shingle once."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        raw = hashes[at : at + 4096].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


_RANDOM = np.random.default_rng(SEED)
_FACTOR = _RANDOM.integers(2**63, size=(BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RANDOM.integers(2**63, size=(BANDS * ROWS, 1), dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _bands(hashes: np.ndarray) -> bytes:
    """For each band a hash of its least values over the set; an empty set has one value for all."""
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 4096):
        mixed = hashes[None, at : at + 4096] * _FACTOR + _SHIFT
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        least = np.minimum(least, mixed.min(axis=1))
    keys = least.astype("<u8").reshape(BANDS, ROWS)
    return b"".join([xxhash.xxh64_digest(k.tobytes(), SEED) for k in keys])


def _digest(hashes: np.ndarray) -> int:
    """64 bits that stand for a set."""
    return int.from_bytes(xxhash.xxh3_64_digest(hashes.astype("<u8").tobytes(), SEED), "little", signed=True)


def _described(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for t in part.column(1).to_pylist():
                    hashes = shingle_set(t, shingle)
                    rows.append((_digest(hashes), _set_fingerprint(hashes), _bands(hashes)))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc_id", "id", "fp", "bands"])

    return run


def _entries(masks: list[int], hot: dict[int, int], bands: bool, under_masks: bool):
    """A row for each bucket of a text: ``k`` (its hash; odd for bands, even for masks), ``fp``, ``id`` and ``label``. A text of a
    hot bucket goes to every pair of the bucket's parts that has its own."""
    under = np.array(masks, np.uint64)
    wanted = np.array([under_masks] * len(masks) + [bands] * BANDS)
    factor = np.random.default_rng(SEED + 1).integers(2**63, size=len(wanted), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    kind = np.array([0] * len(masks) + [1] * BANDS, np.uint64)[wanted]
    factor, n = factor[wanted], int(wanted.sum())
    hot_keys = np.array(sorted(hot), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                fp, ident, label = (part.column(i).to_numpy() for i in (0, 1, 3))
                banded = np.frombuffer(b"".join(part.column(2).to_pylist()), "<u8").reshape(-1, BANDS)
                values = np.concatenate([fp.view(np.uint64)[:, None] & under, banded], axis=1)[:, wanted]
                k = _mixed(_mixed(values * factor) + factor) & ~np.uint64(1) | kind
                columns = [k.view(np.int64).ravel(), fp.repeat(n), ident.repeat(n), label.repeat(n)]
                if len(hot_keys):
                    often = np.flatnonzero(np.isin(columns[0], hot_keys))
                    more = [_dealt(*(int(c[i]) for c in columns), hot[int(columns[0][i])]) for i in often.tolist()]
                    rest = np.ones(len(columns[0]), bool)
                    rest[often] = False
                    columns = [np.concatenate([v[rest], *(m[c] for m in more)]) for c, v in enumerate(columns)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["k", "fp", "id", "label"])

    return run


ENTRY = "k long, fp long, id long, label long"


def _dealt(k: int, fp: int, ident: int, label: int, parts: int) -> list[np.ndarray]:
    """The pairs of parts of a hot bucket that a text belongs to, as buckets of their own."""
    own = np.uint64(ident % parts)
    other = np.arange(parts, dtype=np.uint64)
    pair = np.minimum(other, own) * np.uint64(parts) + np.maximum(other, own)
    keys = _mixed((pair + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(k % 2**64)) & ~np.uint64(1) | np.uint64(k & 1)
    return [keys.view(np.int64), *(np.full(parts, v, np.int64) for v in (fp, ident, label))]


def _near(fp: np.ndarray, others: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count((fp ^ others).view(np.uint64)) <= radius


def _spanned(fp: np.ndarray, label: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Pairs (as positions) within ``radius`` bits that, with the equality of labels, connect all that such pairs connect.

    Each group is paired with the first text that one of its own is near to. What lies in different
    groups then is compared, smaller groups with all others, until they are one.
    """
    group = np.unique(label, return_inverse=True)[1]
    pairs, left, n_groups = [], np.arange(len(fp)), int(group.max()) + 1
    while len(left) and n_groups > 1:
        first = left[0]
        near = _near(fp[first], fp[left], radius)
        met, at = np.unique(group[left[near]], return_index=True)
        at = left[near][at[met != group[first]]]
        pairs += [(first, m) for m in at]
        n_groups -= len(at)
        group[np.isin(group, met)] = group[first]
        left = left[~near]
    sizes = np.bincount(group)
    largest = sizes.argmax()
    for g in np.argsort(sizes, kind="stable"):
        if g == largest or n_groups == 1 or not sizes[g]:
            continue
        for m in np.flatnonzero(group == g):
            other = np.flatnonzero(group != group[m])
            for o in other[_near(fp[m], fp[other], radius)]:
                if group[o] != group[m]:
                    pairs.append((m, o))
                    n_groups -= 1
                    group[group == group[m]] = group[o]
    return pairs


def _runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Columns of whole runs of equal first values, and the runs' bounds; rows come sorted by the first column."""
    held = None
    for batch, last in _with_last(batches):
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:width]]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
            held = None
        if not len(cols[0]):
            continue
        starts = same_runs(cols[0])
        if not last:
            held = [c[starts[-2] :] for c in cols]
            cols, starts = [c[: starts[-2]] for c in cols], starts[:-1]
        if len(starts) > 1:
            yield cols, starts


def _candidates(radius: int):
    """For entries sorted by bucket and id: pairs of ids (least first) that connect the labels of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (k, fp, ident, label), starts in _runs(batches, 4):
            sizes = np.diff(starts)
            two = starts[:-1][sizes == 2]
            limit = np.where(k[two] & 1, WIDE, radius)
            two = two[(np.bitwise_count((fp[two] ^ fp[two + 1]).view(np.uint64)) <= limit) & (label[two] != label[two + 1])]
            a, b = [ident[two]], [ident[two + 1]]
            for s in np.flatnonzero(sizes > 2):
                lo, hi = starts[s], starts[s + 1]
                pairs = _spanned(fp[lo:hi], label[lo:hi], WIDE if k[lo] & 1 else radius) if (label[lo:hi] != label[lo]).any() else []
                if pairs:
                    x, y = np.array(pairs).T
                    a.append(ident[lo:hi][x])
                    b.append(ident[lo:hi][y])
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [shingle_set(t, shingle) for t in part.column(1).to_pylist()]
                arrays = [part.column(0), pa.array(map(_digest, found), pa.int64()), pa.array([x.astype("<u8").tobytes() for x in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["node", "id", "raw"])

    return run


def _alike(sets: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (as positions) that span the sets connected by a Jaccard similarity of ``least`` or more, all pairs compared."""
    n = np.array([len(s) for s in sets], np.int64)
    hashes = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    member = np.repeat(np.arange(len(sets)), n)
    _, place, times = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = times[place] > 1
    member, place = member[shared], (np.cumsum(times > 1) - 1)[place[shared]]
    by = np.argsort(place, kind="stable")
    member, place = member[by], place[by]
    both = np.zeros((len(sets), len(sets)), np.float64)
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, COLUMNS):
        s, e = np.searchsorted(place, [low, low + COLUMNS])
        dense = np.zeros((len(sets), COLUMNS), np.float32)
        dense[member[s:e], place[s:e] - low] = 1
        both += dense @ dense.T
    union = n[:, None] + n[None] - both
    root = smallest_reachable(len(sets), *np.nonzero((both >= least * union - 1e-9) & (union > 0)))
    far = np.flatnonzero(root != np.arange(len(sets)))
    return root[far], far


def _whole_groups(least: float):
    """For rows (root, id, raw) sorted by root: links of the ids whose sets are alike, all pairs of a root compared."""

    def links(rows: list[tuple]) -> pa.RecordBatch:
        a, b = _alike([np.frombuffer(r[1], "<u8") for r in rows], least)
        ident = np.array([r[0] for r in rows], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ident[a]), pa.array(ident[b])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = [], None
        for batch in batches:
            for root, ident, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if root != of:
                    if held:
                        yield links(held)
                    held, of = [], root
                held.append((ident, raw))
        if held:
            yield links(held)

    return run


def _stars(least: float):
    """For rows (a, piece, id, raw) sorted so that the set of ``a`` leads its piece: links of ``a`` with the ids that are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, centre = None, None
        for batch in batches:
            found = []
            for a, piece, ident, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
                own = np.frombuffer(raw, "<u8")
                if (a, piece) != of:
                    of, centre = (a, piece), own  # every piece begins with it
                    continue
                both = len(np.intersect1d(centre, own, assume_unique=True))
                union = len(centre) + len(own) - both
                if union and both >= least * union - 1e-9:
                    found.append((a, ident))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run


def _compared(pairs: DataFrame, sets: DataFrame, least: float, star: int = STAR) -> DataFrame:
    """The ``pairs`` (``a``, ``b``, distinct) whose ``sets`` are alike. A set that is paired with many is sent once to each piece of
    ``star`` of them."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / star).cast("int").alias("pieces"))
    own = sets.select(F.col("id").alias("_id"), "raw")
    members = pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("pieces")).cast("int").alias("piece"))
    members = members.join(own, F.col("b") == F.col("_id")).select("a", "piece", F.col("b").alias("id"), "raw", F.lit(1).alias("_kind"))
    centres = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece")).join(own, F.col("a") == F.col("_id"))
    rows = members.union(centres.select("a", "piece", F.col("a").alias("id"), "raw", F.lit(0).alias("_kind")))
    dealt = rows.repartition("a", "piece").sortWithinPartitions("a", "piece", "_kind").select("a", "piece", "id", "raw")
    return dealt.mapInArrow(_stars(least), "a long, b long")


def _hot_buckets(nodes: DataFrame, masks: list[int], hot: int, sample: int) -> dict[int, int]:
    """Buckets with more than ``hot`` entries and the parts they are dealt in, by a sample of the texts: at most HOTTEST."""
    some = nodes.filter(F.pmod(F.xxhash64("id"), F.lit(sample)) == 0).select("fp", "id", "bands", "id")
    least = max(hot / sample, some.count() * (len(masks) + BANDS) / HOTTEST)
    found = some.mapInArrow(_entries(masks, {}, True, True), ENTRY).groupBy("k").agg(F.count("*").alias("n")).filter(F.col("n") > least)
    return {r["k"]: max(2, -(-2 * r["n"] * sample // hot)) for r in found.collect()}


def _starred(pairs: DataFrame) -> DataFrame:
    """Links that connect what ``pairs`` (``a`` < ``b``) connect: each ``b`` with the least it is paired with, and that with the
    others. A text has at most one pair a bucket, so the list is short; texts of a group share the others."""
    own = pairs.groupBy("b").agg(F.min("a").alias("a"), F.collect_set("a").alias("s"))
    return own.select("a", F.explode(F.array_union("s", F.array("b"))).alias("b")).filter("a <> b").distinct()


def similar_links(
    docs: DataFrame, shingle: int, radius: int, least: float, block: int = SETS, hot: int = HOT, sample: int = SAMPLE
) -> tuple[DataFrame, DataFrame]:
    """For ``docs`` (``doc_id`` long without nulls, ``text`` binary): ``id`` of each set of shingles with ``node``, its smallest key,
    and links ``a``, ``b`` that connect the ids whose sets have a Jaccard similarity of ``least`` or more.

    Candidates are texts whose fingerprints differ in at most ``radius`` bits, all of them by the covering masks, and in at most
    ``WIDE`` bits if they share a band of least hashes. Every entry of a bucket goes through one exchange, bands
    first; a bucket of one ends there, others give pairs that span them, and what bands have connected needs no pair under
    the masks. What candidates connect is compared exactly.
    Groups of up to ``block`` sets meet whole, each set sent once. Larger groups are never brought together: every
    text is compared with one that spans its bucket; what is still apart then meets in comparisons of two parts of the group,
    so that a group of copies costs a comparison a text, and no pairs are listed.
    """
    masks = covering_masks(radius)
    marked = docs.mapInArrow(_described(shingle), "doc_id long, id long, fp long, bands binary")
    nodes = stored(marked.groupBy("id").agg(F.min("doc_id").alias("node"), F.first("fp").alias("fp"), F.first("bands").alias("bands")), "nodes")
    large = _hot_buckets(nodes, masks, hot, sample)

    def met(labelled: DataFrame, rows, bands: bool, under_masks: bool) -> DataFrame:
        entries = labelled.select("fp", "id", "bands", "label").mapInArrow(_entries(masks, large, bands, under_masks), ENTRY)
        return entries.repartition("k").sortWithinPartitions("k", "id").mapInArrow(rows, "a long, b long").distinct()

    banded = stored(met(nodes.withColumn("label", F.col("id")), _candidates(radius), True, False), "pairs")
    masked = stored(met(_labelled(nodes, components(_starred(banded))), _candidates(radius), False, True), "pairs")
    pairs = banded.union(masked)
    reach = components(_starred(pairs)).select(F.col("node").alias("id"), "root")
    sizes = reach.groupBy("root").agg((F.count("*") > block).alias("big"))
    chosen = stored(reach.join(sizes, "root"), "chosen")

    firsts = nodes.join(chosen, "id").select("id", "node", "root", "big")
    texts = docs.join(firsts.select("node").distinct(), docs["doc_id"] == F.col("node"), "left_semi").select("doc_id", "text")
    sets = texts.mapInArrow(_sets(shingle), "node long, id long, raw binary")
    # a key may have several texts, and repeated rows: only those of its ids, once each
    sets, folder = written(sets.join(firsts, ["id", "node"]).dropDuplicates(["id"]), "sets")
    whole = sets.filter("not big").repartition("root").sortWithinPartitions("root", "id")
    links = stored(whole.select("root", "id", "raw").mapInArrow(_whole_groups(least), "a long, b long"), "links")
    if chosen.filter("big").head(1):
        own = sets.filter("big")
        big = chosen.filter("big").select("id")
        first = pairs.join(big, pairs["b"] == big["id"], "left_semi").groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        first = stored(first, "pairs")
        linked = stored(_compared(first, own, least), "links")
        members = _labelled(chosen.filter("big").select("id", "root"), components(linked))
        dealt = _apart(members, own.select("id", "raw"), block)
        links = links.union(linked).union(stored(dealt.mapInArrow(_whole_groups(least), "a long, b long"), "links"))
    drop_folder(docs.sparkSession, folder)
    return nodes.select("id", "node"), links


def _labelled(nodes: DataFrame, reach: DataFrame) -> DataFrame:
    """``nodes`` with ``label``, the root that ``reach`` gives them or their own id."""
    of = reach.select(F.col("node").alias("_id"), F.col("root").alias("_root"))
    joined = nodes.join(of, F.col("id") == F.col("_id"), "left")
    return joined.withColumn("label", F.coalesce("_root", "id")).drop("_id", "_root")


def _apart(members: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """``members`` (``id``, ``root``, ``label``) with their sets, dealt into comparisons (of at most two parts) in which all that differ
    in their label meet: rows (comparison, id, raw), sorted by comparison.

    A label of half a block or more has parts of its own, and no two of them are compared, nor a part with itself: what
    is linked already costs nothing. All other labels of a root share parts.
    """
    sizes = members.groupBy("root", "label").agg(F.count("*").alias("n"))
    own = sizes.filter(F.col("n") >= block / 2).select("label", F.ceil(F.col("n") / block).cast("int").alias("own"))
    several = sizes.groupBy("root").agg(F.count("*").alias("labels"), F.sum(F.when(F.col("n") < block / 2, F.col("n"))).alias("rest"))
    several = several.filter("labels > 1").select("root", F.ceil(F.col("rest") / block).cast("int").alias("pool"))
    rows = members.join(several, "root").join(own, "label", "left")
    nth = F.when(F.col("own").isNotNull(), F.pmod("id", F.col("own"))).otherwise(F.pmod(F.xxhash64("label"), F.col("pool")))
    named = stored(rows.select("root", "id", F.when(F.col("own").isNotNull(), F.col("label")).alias("of"), nth.cast("int").alias("nth")), "parts")
    part = F.xxhash64("root", "of", "nth")
    parts = named.groupBy("root", "of", "nth").agg(F.count("*").alias("n")).select("root", "of", part.alias("part"))  # a part has up to a block of rows
    other = parts.select("root", F.col("of").alias("_of"), F.col("part").alias("_part"))
    pairs = parts.join(other, "root").filter((F.col("part") <= F.col("_part")) & (F.col("of").isNull() | F.col("_of").isNull() | (F.col("of") != F.col("_of"))))
    pairs = pairs.select("part", "_part", F.xxhash64(F.lit(7), "part", "_part").alias("meets"))
    each = pairs.select("part", "meets").union(pairs.filter("part <> _part").select("_part", "meets"))
    placed = named.select("id", part.alias("part")).join(each, "part").join(sets, "id")
    return placed.select("meets", "id", "raw").repartition("meets").sortWithinPartitions("meets", "id")


def similar_representatives(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, radius: int = 5, least: float = 0.8, block: int = SETS
) -> DataFrame:
    """The rows of ``docs`` whose key is the smallest of its group, once each; all columns stay as they are.

    Texts link if the sets of their shingles have a Jaccard similarity of ``least`` or more; equal sets are one node,
    texts without words are all equal. A group is what links connect. Null texts have no words; rows
    without a key can't be told apart and stay.
    """
    given = docs.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    )
    nodes, links = similar_links(given, shingle, radius, least, block)
    of = lambda c: nodes.select(F.col("id").alias(c), F.col("node").alias(f"_{c}"))
    # by key from here on, so that the texts of one key are one
    keyed = links.join(of("a"), "a").join(of("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    reach = components(keyed).filter("node <> root").select(F.col("node").alias("_node")).distinct()
    kept = settled(nodes.select("node").distinct().join(reach, F.col("node") == F.col("_node"), "left_anti").select(F.col("node").alias("_kept")))
    return _first_rows(docs, key, kept)


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose key is their component's smallest, once each; all columns stay as they are.
    Rows without a key can't be told apart and stay."""
    found = near_duplicates(docs, key, text, **options)
    kept = settled(found.filter("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct())
    return _first_rows(docs, key, kept)


def _first_rows(docs: DataFrame, key: str, kept: DataFrame) -> DataFrame:
    """One row of ``docs`` for each key in ``_kept``, and the rows without a key."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(key).cast("long").alias("_id"))
    met = rows.join(kept, rows["_id"] == kept["_kept"], "left_semi")
    first = F.row_number().over(Window.partitionBy("_id").orderBy("_row"))
    met = met.withColumn("_nth", first).filter("_nth = 1").select("_row")
    return met.union(rows.filter("_id is null").select("_row")).select("_row.*")
