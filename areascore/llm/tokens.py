"""Token ids as Parquet lists: dictionary or delta encoding, row groups and pages of set sizes, page indexes."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The id behind each document.
END = 2
#: Bytes of a row group before compression, rows of a page, and bytes of a page.
ROW_GROUP, PAGE_ROWS, PAGE = 32 << 20, 2000, 1 << 20
#: Characters of text that are encoded at once, and documents.
PIECE, PIECE_ROWS = 1 << 20, 512
#: Words after which a worker starts a new memory, beside the last one, and letters of a word up to which it is remembered.
REMEMBERED, LONG_WORD = 250_000, 64
#: Classes of the characters in the pattern by which byte-level vocabularies cut a text: ``'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+|
#: ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+``. Fixed values.
LETTER, NUMBER, OTHER, WHITE, UNKNOWN = range(5)
#: Where a long text may be cut, since a word of the pattern starts there whatever follows.
WORD_START = re.compile("(?<=[!-~]) (?=[!-~])")

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: its own if it is printable, else one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Little-endian 32-bit ids of texts, as the library gives them.

    No merge crosses a word of the vocabulary's pattern, so the library's model encodes each word once and a worker
    remembers it. Texts are cut into words as columns of characters, by the class that the library puts a character into
    (probed once each). Equal words of a block are found by hash and compared. Texts with a special token are encoded whole.
    """

    def __init__(self, model: str):
        self.model = model
        self.library = self._load()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.kinds = np.full(0x110000, UNKNOWN, np.uint8)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.up = self.down = np.empty(0, np.uint64)

    def __reduce__(self):
        return Encoder, (self.model,)

    def _load(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(self.model)
        library.no_padding()
        library.no_truncation()
        return library

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e)}I", *e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, tokenize: Callable, word: str) -> bytes:
        ids = [t.id for t in tokenize(word.encode().decode("latin-1").translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _classes(self, points: np.ndarray) -> np.ndarray:
        """The class of each character: the one that it doesn't end."""
        kinds = self.kinds[points]
        if (kinds == UNKNOWN).any():
            cut = self.library.pre_tokenizer.pre_tokenize_str
            for c in np.unique(points[kinds == UNKNOWN]).tolist():
                one = [k for k, x in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(cut(x + chr(c))) == 1]
                self.kinds[c] = one[0] if one else WHITE
            kinds = self.kinds[points]
        return kinds

    def _begins(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where the words begin in texts that begin at ``first``; the pattern's cases as columns."""
        kinds, n = self._classes(points), len(points)
        begins = first.copy()
        begins[1:] |= kinds[1:] != kinds[:-1]
        white = kinds == WHITE
        # the last of several spaces stands alone, a blank belongs to what follows
        last = np.flatnonzero(white[:-1] & ~white[1:] & ~first[1:])
        begins[last] = True
        begins[last[points[last] == 32] + 1] = False
        # an apostrophe that begins a word takes one of its endings
        at = np.flatnonzero((points == 39) & begins)
        at = at[at + 1 < n]
        at = at[~first[at + 1]]
        next1 = points[at + 1]
        beyond = np.minimum(at + 2, n - 1)
        next2 = np.where((at + 2 < n) & ~first[beyond], points[beyond], 0)
        size = np.zeros(len(at), np.int64)
        for ending in ("s", "t", "m", "d", "re", "ve", "ll"):
            same = next1 == ord(ending[0])
            size[same if len(ending) == 1 else same & (next2 == ord(ending[1]))] = len(ending)
        at, size = at[size > 0], size[size > 0]
        begins[at + 1] = False
        after = at + 1 + size
        begins[after[after < n]] = True
        return np.flatnonzero(begins)

    def _hashes(self, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(self.up) < len(points):
            self.up, self.down = (np.multiply.accumulate(np.full(len(points), x, np.uint64)) for x in (_BASE, _INVERSE))
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((points + np.uint64(1)) * self.up[: len(points)], out=sums[1:])
        return (sums[end] - sums[start]) * self.down[start]

    def _found(self, words: list[str]) -> list[bytes]:
        """The ids of different words. Those that aren't met again until the next memory is full are forgotten."""
        if len(self.known) > REMEMBERED:
            self.known, self.before = {}, self.known
        known, before, tokenize = self.known, self.before, self.library.model.tokenize
        found = list(map(known.get, words))
        for i, ids in enumerate(found):
            if ids is None:
                word = words[i]
                ids = found[i] = before.get(word) or self._word(tokenize, word)
                if len(word) <= LONG_WORD:
                    known[word] = ids
        return found

    def _block(self, texts: list[str]) -> list[bytes]:
        joined = "".join(texts)
        if not joined:
            return [b""] * len(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        first = np.zeros(len(points) + 1, bool)
        first[starts] = True
        start = self._begins(points, first[:-1])
        end = np.append(start[1:], len(points))
        _, one, which = np.unique(self._hashes(points, start, end), return_index=True, return_inverse=True)
        size = end - start
        like = np.arange(len(points)) + np.repeat(start[one][which] - start, size)
        if (size != size[one][which]).any() or (points != points[like]).any():
            return self._whole(texts)  # different words with one hash
        found = self._found([joined[a:b] for a, b in zip(start[one].tolist(), end[one].tolist())])
        n = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, offset = np.frombuffer(b"".join(found), "<u4"), np.cumsum(n) - n
        each = n[which]
        upto = np.concatenate([[0], np.cumsum(each)])
        ids = flat[np.arange(upto[-1]) + np.repeat(offset[which] - upto[:-1], each)].tobytes()
        bounds = (4 * upto[np.searchsorted(start, starts)]).tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def __call__(self, texts: list[str]) -> list[bytes]:
        own = [t for t in texts if not any(s in t for s in self.special)]
        if len(own) == len(texts):
            if all(len(t) <= 2 * PIECE for t in texts):
                return self._block(texts)
            return [b"".join(x for part in _parts(t) for x in self._block([part])) for t in texts]
        odd = iter(self._whole([t for t in texts if any(s in t for s in self.special)]))
        rest = iter(self(own))
        return [next(odd) if any(s in t for s in self.special) else next(rest) for t in texts]


def _parts(text: str) -> Iterator[str]:
    """A long text in parts of about ``PIECE`` characters, cut before words."""
    at = 0
    while len(text) - at > PIECE and (cut := WORD_START.search(text, at + PIECE)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def _pieces(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        if held and (size + len(t) > PIECE or len(held) == PIECE_ROWS):
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def writer_options(encoding: str, row_group: int, page_rows: int) -> dict[str, str]:
    """Options of the Parquet writer. Pages of the second version give delta encoding to integers that have no dictionary;
    the writer adds column and offset indexes by itself."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"encoding must be dictionary or delta, not {encoding!r}")
    return {
        "parquet.writer.version": "v2",
        "parquet.block.size": str(row_group),
        "parquet.page.size": str(PAGE),
        "parquet.page.row.count.limit": str(page_rows),
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#tokens.list.element": str(encoding == "dictionary").lower(),
        "parquet.dictionary.page.size": str(4 << 20),
        "compression": "zstd",
    }


def write_tokens(
    docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", path: str | None = None, end: int = END,
    encoding: str = "dictionary", row_group: int = ROW_GROUP, page_rows: int = PAGE_ROWS,
) -> None:
    """Encode ``docs`` and write them to ``folder`` in ascending order of the key.

    ``folder/tokens`` has the files, one for each range of keys: ``part`` (the range's number), ``doc_id``,
    ``local_start`` (ids before it in its file), ``n_tokens`` (with the end id) and ``tokens`` (list of int).
    ``folder/files`` has one row a file: its part, path, first and last key, documents, ids and the ids of all files before.

    Texts are dealt into ranges and encoded there, so that no task holds more than a range and nothing is
    encoded twice. A null text is empty and has the end id only; null keys come first; rows with one key are ordered by their text,
    equal rows come as often as given and may lie in two files; whole texts of any length; an empty table
    gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    with open(path or default_path(), encoding="utf-8") as file:
        # as large as the file; a worker keeps it, and the words it remembers, from task to task
        encoder = spark.sparkContext.broadcast(Encoder(file.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, start = encoder.value, TaskContext.get().partitionId(), 0
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            at = 0
            for texts in _pieces(batch.column(1).to_pylist()):
                ids = encode(texts)
                n = np.fromiter((len(i) // 4 + 1 for i in ids), np.int64, len(ids))
                offsets = np.concatenate([[0], np.cumsum(n)])
                flat = np.frombuffer(last.join(ids) + last, "<i4")
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
                columns = [pa.array(np.full(len(n), part, np.int32)), batch.column(0).slice(at, len(n)), pa.array(start + offsets[:-1]), pa.array(n), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "local_start", "n_tokens", "tokens"])
                at += len(n)
                start += int(offsets[-1])

    full = F.coalesce(F.col(text), F.lit(""))
    given = docs.select(F.col(key).cast("long").alias("doc_id"), full.alias("text"), F.xxhash64(full).alias("_h"), F.monotonically_increasing_id().alias("_n"))
    # the last column only splits equal rows, which would all be in one range
    dealt = given.repartitionByRange("doc_id", "_h", "_n").sortWithinPartitions("doc_id", "_h", "text").select("doc_id", "text")
    rows = dealt.mapInArrow(run, "part int, doc_id long, local_start long, n_tokens long, tokens array<int>")
    rows.write.options(**writer_options(encoding, row_group, page_rows)).parquet(f"{folder}/tokens")

    files = _rows(spark, folder).groupBy("part").agg(
        F.first("_metadata.file_path").alias("path"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"),
        F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_ids"),
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files.withColumn("ids_before", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))).write.parquet(f"{folder}/files")


def _rows(spark: SparkSession, folder: str, *paths: str) -> DataFrame:
    schema = "part int, doc_id long, local_start long, n_tokens long, tokens array<int>"
    return spark.read.schema(schema).parquet(*(paths or [f"{folder}/tokens"]))


def read_documents(spark: SparkSession, folder: str, first: int | None = None, last: int | None = None, tokens: bool = True) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and, unless ``tokens`` is false, ``tokens`` of the
    documents with keys from ``first`` to ``last``. The bounds reach the scan, where row groups and pages outside are
    skipped by their statistics; without ``tokens`` the lists aren't read."""
    rows = _rows(spark, folder)
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.filter(F.col("doc_id") <= last)
    files = spark.read.parquet(f"{folder}/files").select("part", "ids_before")
    kept = ["doc_id", (F.col("ids_before") + F.col("local_start")).alias("start"), "n_tokens"]
    return rows.join(files, "part").select(*kept, *(["tokens"] if tokens else []))


def read_span(spark: SparkSession, folder: str, begin: int, end: int) -> DataFrame:
    """The ids at the places ``begin`` to ``end`` (exclusive) of the whole sequence: one row for each document that has some, with
    ``doc_id``, ``start`` (of the row's ids) and ``tokens``. Only files that hold a part of the span are opened."""
    files = spark.read.parquet(f"{folder}/files").filter((F.col("ids_before") < end) & (F.col("ids_before") + F.col("n_ids") > begin))
    paths = [r["path"] for r in files.select("path").collect()]  # the files of the span
    if not paths:
        return _rows(spark, folder).filter("false").select("doc_id", F.col("local_start").alias("start"), "tokens")
    met = _rows(spark, folder, *paths).join(files.select("part", "ids_before"), "part")
    met = met.withColumn("start", F.col("ids_before") + F.col("local_start")).filter((F.col("start") < end) & (F.col("start") + F.col("n_tokens") > begin))
    skip = F.greatest(F.lit(begin) - F.col("start"), F.lit(0))
    length = F.least(F.col("n_tokens"), F.lit(end) - F.col("start")) - skip
    return met.select("doc_id", (F.col("start") + skip).alias("start"), F.slice("tokens", (skip + 1).cast("int"), length.cast("int")).alias("tokens"))


def with_crc32(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``rows`` with ``ids_crc32``, of the ids as little-endian unsigned 32-bit integers, in place of the list."""
    kept = [f for f in rows.schema.fields if f.name != tokens]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(names))
            offsets, flat = lists.offsets.to_numpy(), np.ascontiguousarray(lists.values.to_numpy(), "<i4")
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(crc, pa.int64())], names=[*names, "ids_crc32"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.select(*names, tokens).mapInArrow(run, f"{schema}, ids_crc32 long")
