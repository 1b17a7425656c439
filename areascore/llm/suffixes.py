"""Removal of long repeated passages: column-wise suffix order and common prefixes of many documents at once.

Two windows can only be equal if the text around their anchor is, the part of the window whose hash is
least. Documents are cut into segments, the runs of windows that share an anchor, and segments meet under
their anchor's hash, aligned at it; equal segments are one, with their number. A task builds the suffix order of its
segments from right to left: each round inserts one symbol of each segment. The symbols that stand before the suffixes, in
suffix order, are the collection's Burrows-Wheeler transform; sorting by them (stably, so that the order of the rest holds)
gives the order of the longer suffixes, and the common prefixes of neighbours are updated with it. A window is repeated if
its segment occurs several times, or if its suffix has at least its length in common with a neighbour. The
symbols of a round lie together in a sequential external file, which is written and read once.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areascore.llm.common import settled, written
from areascore.sources.tables import drop_folder

#: Bytes of a window and of an anchor.
WINDOW, ANCHOR = 400, 64
#: Bytes that are hashed at once, bytes of a block of segments, and different segments of an anchor up to which
#: they are sorted in one task; windows of more frequent anchors are matched by their own digest.
CHUNK, BLOCK, FREQUENT = 1 << 20, 8 << 20, 4000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = np.uint64((1 << 24) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Finds the segments of byte strings: runs of windows with the same anchor."""

    def __init__(self, window: int = WINDOW, anchor: int = ANCHOR):
        self.window, self.anchor = window, anchor
        self.up, self.down = _powers(_BASE, 1), _powers(_INVERSE, 1)

    def hashes(self, raw: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each run of ``anchor`` bytes."""
        if len(self.up) < len(raw):
            self.up, self.down = _powers(_BASE, len(raw)), _powers(_INVERSE, len(raw))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[: len(raw)], out=sums[1:])
        h = (sums[self.anchor :] - sums[: -self.anchor]) * self.down[: len(raw) - self.anchor + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        return h

    def places(self, h: np.ndarray) -> np.ndarray:
        """For each window its anchor's place: least hash (40 bits), then leftmost."""
        span = self.window - self.anchor + 1
        n = len(h) - span + 1
        keyed = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        padded = np.full(-(-len(h) // span) * span, ~np.uint64(0), np.uint64)
        padded[: len(h)] = keyed
        rows = padded.reshape(-1, span)
        right = np.minimum.accumulate(rows, axis=1).ravel()
        left = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        return (np.minimum(left[:n], right[span - 1 : span - 1 + n]) & _PLACE).astype(np.int64)

    def segments(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, start, windows, anchor's offset, anchor's hash) of all segments, for parts of the texts."""
        for parts in _chunks(texts, self.window):
            raw = np.frombuffer(b"".join(texts[i][s:e] for i, s, e in parts), np.uint8)
            sizes = np.array([e - s for _, s, e in parts])
            begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            h = self.hashes(raw)
            place = self.places(h)
            part = np.repeat(np.arange(len(parts)), sizes)[: len(place)]
            fits = np.arange(len(place)) + self.window <= (begins + sizes)[part]
            change = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (part[1:] != part[:-1]) | (fits[1:] != fits[:-1])]))
            counts = np.diff(np.concatenate([change, [len(place)]]))
            good = fits[change]
            at, counts = change[good], counts[good]
            own = part[at]
            text = np.array([p[0] for p in parts])[own]
            start = at - begins[own] + np.array([p[1] for p in parts])[own]
            yield text, start, counts, place[at] - at, h[place[at]]


def _chunks(texts: list[bytes], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Texts in parts of at most ``CHUNK`` bytes together; a longer text is cut so that each window is in one part."""
    parts, size = [], 0
    for i, t in enumerate(texts):
        for s in range(0, max(1, len(t) - window + 1), CHUNK):
            e = min(len(t), s + CHUNK + window - 1)
            if e - s < window:
                continue
            if parts and size + e - s > 2 * CHUNK:
                yield parts
                parts, size = [], 0
            parts.append((i, s, e))
            size += e - s
    if parts:
        yield parts


def repeated_windows(
    strings: list[bytes], offsets: list[int], groups: np.ndarray, window: int, times: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(string, place) of each window that another string of its group has too, or whose string occurs several ``times``.
    Strings of a group are aligned at their offsets and differ; ``groups`` ascends.

    Columns are inserted from right to left. ``order`` lists the strings by what follows from the column on, ``end``
    the column where what a string has in common with the one before it ends, and ``transform`` the symbols before those
    suffixes in their order.
    """
    offset = np.array(offsets)
    size = np.array([len(s) for s in strings])
    left, right = int(offset.max()), int((size - offset).max())
    low, high = left - offset, left - offset + size
    table = np.zeros((len(strings), left + right), np.uint8)
    for i, s in enumerate(strings):
        table[i, low[i] : high[i]] = np.frombuffer(s, np.uint8)
    rank = np.unique(groups, return_inverse=True)[1]
    rank = rank.astype(np.uint16 if len(strings) < 65536 else np.int64)
    order = np.arange(len(strings))
    end = np.full(len(strings), left + right, np.int64)
    several = np.zeros(len(strings), bool) if times is None else times > 1
    found_s, found_c = [], []
    with tempfile.TemporaryFile() as file:
        np.ascontiguousarray(table.T[::-1]).tofile(file)  # the first round's symbols first
        width, n = left + right, len(strings)
        del table
        file.seek(0)
        for c in range(width - 1, -1, -1):
            transform = np.frombuffer(file.read(n), np.uint8)[order]
            perm = np.argsort(transform, kind="stable")
            perm = perm[np.argsort(rank[order[perm]], kind="stable")]
            new = order[perm]
            here = (low[new] <= c) & (c < high[new])
            same = (transform[perm[1:]] == transform[perm[:-1]]) & (rank[new[1:]] == rank[new[:-1]]) & here[1:] & here[:-1]
            ends = np.full(n, c, np.int64)
            whole = np.flatnonzero(several & (low <= c) & (c + window <= high))
            if len(whole):
                found_s.append(whole)
                found_c.append(np.full(len(whole), c))
            at = np.flatnonzero(same) + 1
            if len(at):
                spans = np.empty(2 * len(at), np.int64)
                spans[::2], spans[1::2] = perm[at - 1] + 1, perm[at] + 1
                # least end between the two in the old order; the last bound may lie past the array
                ends[at] = np.minimum.reduceat(np.append(end, width), spans)[::2]
                hit = at[ends[at] - c >= window]
                if len(hit):
                    both = np.unique(np.concatenate([new[hit], new[hit - 1]]))
                    both = both[~several[both]]  # those are found already
                    found_s.append(both)
                    found_c.append(np.full(len(both), c))
            order, end = new, ends
    if not found_s:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    s = np.concatenate(found_s)
    return s, np.concatenate(found_c) - low[s]


def spans_of(s: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, first, end) of the runs of consecutive places."""
    by = np.lexsort((place, s))
    s, place = s[by], place[by]
    starts = np.concatenate([[True], (s[1:] != s[:-1]) | (place[1:] != place[:-1] + 1)])
    first = np.flatnonzero(starts)
    last = np.concatenate([first[1:], [len(s)]]) - 1
    return s[first], place[first], place[last] + 1


def digest(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    md5 = F.md5(text)
    half = lambda i: F.conv(F.substring(md5, i, 16), 16, -10).cast("long")
    return [half(1).alias("d1"), half(17).alias("d2")]


def _signed(d: bytes) -> np.ndarray:
    return np.frombuffer(d, ">i8").astype(np.int64)


def _find(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(window, anchor)
        for batch in batches:
            d1, d2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for at in range(0, batch.num_rows, 1024):
                texts = batch.column(0).slice(at, 1024).to_pylist()
                for text, start, n, offset, h in finder.segments(texts):
                    cut = zip(text.tolist(), start.tolist(), (start + n + window - 1).tolist())
                    s = _signed(b"".join([xxhash.xxh3_128_digest(texts[i][b:e]) for i, b, e in cut])).reshape(-1, 2)
                    columns = [h.view(np.int64), s[:, 0], s[:, 1], d1[at + text], d2[at + text], start, n, offset]
                    kinds = [np.int64] * 5 + [np.int32] * 3
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c.astype(k)) for c, k in zip(columns, kinds)],
                        names=["a", "s1", "s2", "d1", "d2", "at", "n", "off"],
                    )

    return run


RUN_SCHEMA = "a long, s1 long, s2 long, d1 long, d2 long, at int, n int, off int"


def _cut(window: int):
    """The bytes of the segments that are asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw, asked = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                for at in range(0, len(asked), 4096):
                    part = asked[at : at + 4096]
                    cols = {k: [x[k] for x in part] for k in ("a", "s1", "s2", "off", "found", "often")}
                    cols["bytes"] = [raw[x["at"] : x["at"] + x["n"] + window - 1] for x in part]
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols.values(), kinds)], names=[*cols])

    return run


def _sort(window: int, block: int):
    """Repeated windows of segments that come sorted by anchor: whole anchors, as many as fill a block."""

    def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        groups = np.array([r[0] for r in rows])
        s, place = repeated_windows([r[5] for r in rows], [r[3] for r in rows], groups, window, np.array([r[4] for r in rows]))
        if len(s):
            s, first, end = spans_of(s, place)
            columns = [groups[s], np.array([r[1] for r in rows])[s], np.array([r[2] for r in rows])[s]]
            arrays = [*map(pa.array, columns), pa.array(first.astype(np.int32)), pa.array(end.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=["a", "s1", "s2", "f", "t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if size >= block and row[0] != held[-1][0]:
                    yield from out(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield from out(held)

    return run


def _each_window(window: int):
    """The digest of every window of a segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, s1, s2, found, raw in zip(*(batch.column(i).to_pylist() for i in range(5))):
                n = len(raw) - window + 1
                w = _signed(b"".join([xxhash.xxh3_128_digest(raw[x : x + window]) for x in range(n)])).reshape(-1, 2)
                full = [pa.array(np.full(n, v, np.int64)) for v in (a, s1, s2, found)]
                arrays = [*full, pa.array(np.arange(n, dtype=np.int32)), pa.array(w[:, 0]), pa.array(w[:, 1])]
                yield pa.RecordBatch.from_arrays(arrays, names=["a", "s1", "s2", "found", "x", "w1", "w2"])

    return run


def repeated(texts: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, block: int = BLOCK, frequent: int = FREQUENT) -> DataFrame:
    """For ``texts`` (``raw`` binary, ``d1``, ``d2``): per digest the ``spans`` (s, e) of bytes that repeated windows cover, unmerged."""
    long = texts.filter(F.octet_length("raw") >= window)
    every = settled(long.select("raw", "d1", "d2").mapInArrow(_find(window, anchor), RUN_SCHEMA))
    # Most anchors occur once, and their windows then too. Written, so that the join reads two plain exchanges and a
    # frequent anchor can be split.
    shared = settled(every.groupBy("a").agg(F.count("*").alias("k")).filter("k > 1").select("a"))
    runs = settled(every.join(shared, "a", "left_semi"))
    one = F.struct("d1", "d2", "at", "n", "off")
    segments = runs.groupBy("a", "s1", "s2").agg(F.count("*").alias("found"), F.min(one).alias("one"))
    many = segments.groupBy("a").agg(F.count("*").alias("kinds"))
    segments = settled(segments.join(many, "a").filter("found > 1 or kinds > 1"))

    # the bytes of segments that occur again or whose anchor has others, from one copy of each text
    asked = segments.select(
        F.col("one.d1").alias("d1"), F.col("one.d2").alias("d2"),
        F.struct("a", "s1", "s2", "one.at", "one.n", "one.off", "found", (F.col("kinds") > frequent).alias("often")).alias("x"),
    )
    asked = asked.groupBy("d1", "d2").agg(F.collect_list("x").alias("asked"))  # at most a text's own segments
    single = long.groupBy("d1", "d2").agg(F.first("raw").alias("raw"))
    cut = single.join(asked, ["d1", "d2"]).select("raw", "asked").mapInArrow(
        _cut(window), "a long, s1 long, s2 long, off int, found long, often boolean, bytes binary"
    )
    cut, folder = written(cut, "segments")
    few = cut.filter("not often").select("a", "s1", "s2", "off", "found", "bytes").repartition("a").sortWithinPartitions("a", "s1", "s2")
    places = few.mapInArrow(_sort(window, block), "a long, s1 long, s2 long, f int, t int")
    each = cut.filter("often").select("a", "s1", "s2", "found", "bytes").mapInArrow(
        _each_window(window), "a long, s1 long, s2 long, found long, x int, w1 long, w2 long"
    )
    twice = each.groupBy("w1", "w2").agg(F.sum("found").alias("k")).filter("k > 1").select("w1", "w2")
    often = each.join(twice, ["w1", "w2"]).select("a", "s1", "s2", F.col("x").alias("f"), (F.col("x") + 1).alias("t"))
    places = settled(places.union(often))
    drop_folder(texts.sparkSession, folder)

    back = runs.join(places, ["a", "s1", "s2"]).select(
        "d1", "d2", (F.col("at") + F.col("f")).alias("s"), (F.col("at") + F.col("t") + (window - 1)).alias("e")
    )
    return back.distinct().groupBy("d1", "d2").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def remaining(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for s, e in spans:
        kept.append(raw[at:s])
        at = e
    kept.append(raw[at:])
    return b"".join(kept)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, **options) -> DataFrame:
    """Per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept``, the remaining bytes.

    A byte goes if a string of ``window`` bytes covers it that also starts anywhere else, in the same document or
    another; overlaps count, and strings are judged on the input. A null text counts as empty; texts
    shorter than the window keep everything; equal texts (and repeated rows) remove one another wholly; an empty table
    gives no rows; other columns are ignored.
    """
    given = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))
    given = given.select("doc_id", "raw", *digest(F.col("raw")))
    found = settled(repeated(given, window, **options)).select(
        F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), "spans"
    )
    met = given.join(found, (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                raws = part.column(1).to_pylist()
                spans = [merged(s) for s in part.column(2).to_pylist()]
                kept = [remaining(r, s) for r, s in zip(raws, spans)]
                numbers = [[len(r) for r in raws], [len(r) - len(k) for r, k in zip(raws, kept)], [len(s) for s in spans]]
                arrays = [part.column(0), *(pa.array(n, pa.int64()) for n in numbers), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    kind = given.schema["doc_id"].dataType.simpleString()
    return met.select("doc_id", "raw", "spans").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
