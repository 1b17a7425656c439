"""BPE encoding and decoding with the public word vocabulary: merges over contiguous rank arrays."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Symbols of a word up to which the arrays are scanned; longer words take a heap, with the same result.
SHORT = 64
#: Words that a Python worker remembers.
REMEMBERED = 300_000
NO_RANK = 1 << 60


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Symbols, ranks of their pairs and special strings of a tokenizers file with word ends.

    ``ranks`` holds rank << 20 | merged symbol for left symbol << 20 | right symbol.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        model = given["model"]
        ids = model["vocab"]
        self.symbol = {i: s for s, i in ids.items()}
        self.end = model["end_of_word_suffix"]
        self.ranks = {ids[a] << 20 | ids[b]: rank << 20 | ids[a + b] for rank, (a, b) in enumerate(model["merges"])}
        shown = byte_symbols()
        self.inner = [ids[c] for c in shown]
        self.last = [ids[c + self.end] for c in shown]
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.symbol |= {i: s for s, i in self.special.items()}
        self.pattern = given["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.words = Words(self)


def merge_short(parts: list[int], ranks: dict[int, int]) -> list[int]:
    """Merge the pair of least rank, the leftmost of equals, until none has a rank.

    ``parts`` holds the symbols between the boundaries and ``near`` the rank of each with its right
    neighbour. Each round scans for the minimum, deletes a boundary and refreshes two ranks.
    """
    rank = ranks.get
    near = [rank(a << 20 | b, NO_RANK) for a, b in zip(parts, parts[1:])]
    while near:
        best = min(near)
        if best == NO_RANK:
            break
        i = near.index(best)
        parts[i] = new = best & 0xFFFFF
        del parts[i + 1], near[i]
        if i:
            near[i - 1] = rank(parts[i - 1] << 20 | new, NO_RANK)
        if i < len(near):
            near[i] = rank(new << 20 | parts[i + 1], NO_RANK)
    return parts


def merge_long(parts: list[int], ranks: dict[int, int]) -> list[int]:
    """The same merges, with a heap of (rank, place) over a linked list."""
    size = len(parts)
    after = [*range(1, size), -1]
    before = [*range(-1, size - 1)]
    pairs = [a << 20 | b for a, b in zip(parts, parts[1:])]
    heap = [(ranks[p], i, p) for i, p in enumerate(pairs) if p in ranks]
    heapq.heapify(heap)
    while heap:
        best, i, pair = heapq.heappop(heap)
        j = after[i]
        if parts[i] < 0 or j < 0 or parts[i] << 20 | parts[j] != pair:
            continue
        parts[i], parts[j] = best & 0xFFFFF, -1
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y >= 0 and (pair := parts[x] << 20 | parts[y]) in ranks:
                heapq.heappush(heap, (ranks[pair], x, pair))
    return [p for p in parts if p >= 0]


class Words(dict):
    """word -> its ids as little-endian 32-bit integers, and their symbols joined by spaces. Remembers a
    bounded number of words and starts anew when full."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v = vocabulary

    def __reduce__(self):
        return Words, (self.v,)

    def __missing__(self, word: str) -> tuple[bytes, str]:
        v, raw = self.v, word.encode()
        parts = [v.inner[b] for b in raw[:-1]]
        parts.append(v.last[raw[-1]])
        ids = (merge_short if len(parts) <= SHORT else merge_long)(parts, v.ranks)
        found = struct.pack(f"<{len(ids)}I", *ids), " ".join(map(v.symbol.__getitem__, ids))
        if len(parts) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


class Codec:
    """Encodes and decodes texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.find = regex.compile(vocabulary.pattern, regex.V0).findall
        plain = vocabulary.pattern.replace(r"[\p{L}]", "[a-z]").replace(r"[\p{N}]", "[0-9]")
        plain = plain.replace(r"\p{White_Space}", r"\t-\r ").replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")
        self.find_ascii = re.compile(plain).findall
        self.split = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")").split

    def words(self, text: str) -> list[str]:
        """Words in lower case. Code points younger than the Unicode of the regex module are no letters."""
        if text.isascii():
            return self.find_ascii(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case knows no last sigma
        return self.find(text.lower())

    def both(self, text: str) -> tuple[bytes, str]:
        """Ids of ``text`` in bytes, and the text that these ids decode to."""
        special = self.v.special
        if not any(s in text for s in special):
            found = list(map(self.v.words.__getitem__, self.words(text)))
        else:
            found = []
            for piece in self.split(text):
                if piece in special:
                    found.append((struct.pack("<I", special[piece]), piece))
                else:
                    found += map(self.v.words.__getitem__, self.words(piece))
        return b"".join([f[0] for f in found]), " ".join([f[1] for f in found])

    def decode(self, ids) -> str:
        """Text of integer ids: their symbols joined by spaces, since the file names no decoder."""
        return " ".join(self.v.symbol[i] for i in ids if i in self.v.symbol)


def _per_text(spark: SparkSession, path: str | None, schema: str, columns):
    shared = spark.sparkContext.broadcast(Vocabulary(path or default_path()))  # as large as the file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield columns(codec, part)

    return run


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per document: ``doc_id``, ``n_tokens``, ``ids_sha256`` (of the ids as little-endian unsigned 32-bit integers) and
    ``decoded_sha256`` (of the decoded text in UTF-8). A null text counts as empty and has no tokens;
    whole texts of any length; repeated rows come back as often; other columns are ignored."""
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def columns(codec: Codec, part: pa.RecordBatch) -> pa.RecordBatch:
        out = ([], [], [])
        for t in part.column(1).to_pylist():
            ids, shown = codec.both(t)
            for values, v in zip(out, (len(ids) // 4, sha(ids), sha(shown.encode()))):
                values.append(v)
        arrays = [pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.string(), pa.string()))]
        return pa.RecordBatch.from_arrays([part.column(0), *arrays], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    given = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return given.mapInArrow(_per_text(docs.sparkSession, path, schema, columns), schema)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per document: ``doc_id``, ``ids`` (array of int) and ``n_tokens``. Cases as in ``digests``."""
    import numpy as np

    def columns(codec: Codec, part: pa.RecordBatch) -> pa.RecordBatch:
        ids = [np.frombuffer(codec.both(t)[0], dtype="<u4").astype(np.int32) for t in part.column(1).to_pylist()]
        arrays = [pa.array(ids, pa.list_(pa.int32())), pa.array(list(map(len, ids)), pa.int64())]
        return pa.RecordBatch.from_arrays([part.column(0), *arrays], names=["doc_id", "ids", "n_tokens"])

    schema = "doc_id long, ids array<int>, n_tokens long"
    given = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return given.mapInArrow(_per_text(docs.sparkSession, path, schema, columns), schema)


def decode(tokens: DataFrame, ids: str = "ids", key: str = "doc_id", path: str | None = None) -> DataFrame:
    """Per row: ``doc_id`` and ``text``, the decoded ``ids``; null ids give an empty text."""

    def columns(codec: Codec, part: pa.RecordBatch) -> pa.RecordBatch:
        texts = [codec.decode(i or ()) for i in part.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    schema = "doc_id long, text string"
    given = tokens.select(F.col(key).cast("long").alias("doc_id"), F.col(ids).alias("ids"))
    return given.mapInArrow(_per_text(tokens.sparkSession, path, schema, columns), schema)
