"""Fill-in-middle: content-defined chunks, each distinct one summarised once, tell where a document is cut."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of the rolling hash's window, bits of it that are zero where a chunk ends (a chunk has about 2^BITS bytes),
#: and the least and most bytes of a chunk.
WINDOW, BITS, LEAST, MOST = 32, 10, 64, 16_384
#: Bytes of a text that are hashed at once, and bytes of chunks that a worker remembers.
SECTION, REMEMBERED = 1 << 20, 64 << 20
#: Sentinels of the output. Fixed values.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, RATE, SPM_RATE = 42, 50, 80

_BYTE = np.random.default_rng(SEED).integers(2**32, size=256, dtype=np.uint32)
_PRIME = 0x9E3779B1
_WORD = np.ones(256, dtype=bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False


def _rolling(section: np.ndarray) -> np.ndarray:
    """Hash of each window of ``WINDOW`` bytes: windows double until they are that long."""
    h, step = _BYTE[section], 1
    while step < WINDOW:
        h = h[:-step] * np.uint32(pow(_PRIME, step, 2**32)) + h[step:]
        step *= 2
    return h


def chunk_ends(raw: bytes) -> list[int]:
    """Ends of the chunks of ``raw``: after a window whose hash ends in zeros, where a code point begins. What follows
    a cut of one text follows it in every text that holds the same bytes."""
    if not raw:
        return []
    data = np.frombuffer(raw, np.uint8)
    places = []
    for at in range(0, max(0, len(data) - WINDOW + 1), SECTION):
        found = _rolling(data[at : at + SECTION + WINDOW - 1])
        places.append(np.flatnonzero((found >> np.uint32(32 - BITS)) == 0) + at + WINDOW)
    ends, last = [], 0
    for p in [*(np.concatenate(places).tolist() if places else ()), len(raw)]:
        while p - last > MOST:
            last = _code_point(raw, last + MOST)
            ends.append(last)
        if p - last >= LEAST or p == len(raw):
            last = max(last, _code_point(raw, p))
            if not ends or last > ends[-1]:
                ends.append(last)
    return ends


def _code_point(raw: bytes, at: int) -> int:
    while at < len(raw) and raw[at] & 0xC0 == 0x80:
        at += 1
    return at


def summary(chunk: bytes) -> tuple[int, np.ndarray, bool, bool]:
    """Code points of ``chunk``, the places in it where a word ends before white space, and whether it begins and
    ends inside words. Words that end where a chunk does are counted when chunks are put together."""
    data = np.frombuffer(chunk, np.uint8)
    word = _WORD[data]
    ends = np.flatnonzero(word[:-1] & ~word[1:]).astype(np.int32) + 1
    return int(((data & 0xC0) != 0x80).sum()), ends, bool(word[0]), bool(word[-1])


class Chunks:
    """Summaries of chunks that were seen, found by a hash and used only if the content is equal. Starts anew when full."""

    def __init__(self, most: int = REMEMBERED):
        self.most, self.held, self.known = most, 0, {}
        self.reused = 0

    def __call__(self, chunk: bytes):
        place = xxhash.xxh3_64_intdigest(chunk)
        known = self.known.get(place)
        if known is not None and known[0] == chunk:
            self.reused += 1
            return known[1]
        found = summary(chunk)
        if known is None:
            self.held += len(chunk) + 4 * len(found[1]) + 200
            if self.held > self.most:
                self.known.clear()
                self.held = len(chunk) + 4 * len(found[1]) + 200
            self.known[place] = chunk, found
        return found


class Document:
    """Tokens of a text, counted from the summaries of its chunks."""

    def __init__(self, raw: bytes, chunks: Chunks):
        self.raw, self.starts, self.parts = raw, [], []
        self.before = [0]  # word ends before the end of each chunk
        self.chars = [0]
        at, inside = 0, False
        for end in chunk_ends(raw):
            part = chunks(raw[at:end])
            _, ends, first, last = part
            # a word that ended with the chunk before ends at place 0 of this one
            self.parts.append((ends, inside and not first))
            self.starts.append(at)
            self.before.append(self.before[-1] + len(ends) + (inside and not first))
            self.chars.append(self.chars[-1] + part[0])
            at, inside = end, last
        self.words = self.before[-1] + inside
        self.n = self.words + (bool(raw) and not inside)

    def cut(self, k: int) -> tuple[int, int]:
        """Bytes and code points of the first ``k`` tokens."""
        if k == 0:
            return 0, 0
        if k > self.before[-1]:
            return len(self.raw), self.chars[-1]
        i = bisect_left(self.before, k) - 1
        ends, joined = self.parts[i]
        nth = k - self.before[i] - 1 - joined
        inside = int(ends[nth]) if nth >= 0 else 0
        start = self.starts[i]
        if not inside:
            return start, self.chars[i]
        data = np.frombuffer(self.raw, np.uint8, inside, start)
        return start + inside, self.chars[i] + int(((data & 0xC0) != 0x80).sum())


def draws(doc_id: int, seed: int = SEED) -> list[int]:
    digest = hashlib.sha256(b"%d:%d" % (seed, doc_id)).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def rearranged(doc_id: int | None, raw: bytes, chunks: Chunks, seed: int, rate: int, spm_rate: int) -> tuple:
    """Tokens, form, code points of prefix and middle, and the output."""
    doc = Document(raw, chunks)
    h = draws(doc_id, seed) if doc_id is not None else None
    if not raw or h is None or h[2] % 100 >= rate or any(s in raw for s in (PREFIX, SUFFIX, MIDDLE)):
        return doc.n, "plain", None, None, raw
    a, b = sorted((h[0] % (doc.n + 1), h[1] % (doc.n + 1)))
    (i, chars_i), (j, chars_j) = doc.cut(a), doc.cut(b)
    prefix, middle, suffix = PREFIX + raw[:i], MIDDLE + raw[i:j], SUFFIX + raw[j:]
    spm = h[3] % 100 < spm_rate
    output = suffix + prefix + middle if spm else prefix + suffix + middle
    return doc.n, "spm" if spm else "psm", chars_i, chars_j - chars_i, output


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE
) -> DataFrame:
    """One row per document: ``doc_id``, ``n`` (tokens), ``form`` (plain, psm or spm), ``prefix_chars``, ``middle_chars`` (null
    if plain) and ``output``, the text with its middle moved to the end behind sentinels.

    ``rate`` percent of the documents are rearranged, ``spm_rate`` percent of these with the suffix first; the
    key alone decides which and where. A null text is empty; empty texts, texts with a sentinel and
    documents without a key stay plain. Whole texts of any length; repeated rows come back as often and
    alike; an empty table gives no rows; other columns are ignored. One pass, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [rearranged(i, t, chunks, seed, rate, spm_rate) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    given = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    done = given.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return done.withColumn("output", F.col("output").cast("string"))


def restored(output: str = "output", form: str = "form"):
    """The text that a document of ``fill_in_middle`` had: no part of it holds a sentinel."""
    parts = F.split(F.col(output), "|".join(s.decode() for s in (PREFIX, SUFFIX, MIDDLE)))
    spm, psm = F.concat(parts[2], parts[3], parts[1]), F.concat(parts[1], parts[3], parts[2])
    return F.when(F.col(form) == "plain", F.col(output)).when(F.col(form) == "spm", spm).otherwise(psm)
