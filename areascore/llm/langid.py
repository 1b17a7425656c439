"""Language of a text by a small byte convolutional network."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from areascore.llm.common import settled

#: Bytes of a window; filter widths, filters of each width, size of a byte's vector.
WINDOW, WIDTHS, FILTERS, VECTOR = 128, (2, 3, 4), 16, 8
#: Bounds of the training sample: labelled rows of each language, and windows of each row.
ROWS_PER_LANGUAGE, WINDOWS_PER_ROW = 800, 3
#: How many times the rows of the sample are ranked, and languages up to which their counts are broadcast.
SPARE, BROADCAST_LANGUAGES = 8, 10_000
UNKNOWN = "und"


def held_out(key: Column, parts: int = 5, part: int = 0) -> Column:
    """True for keys whose crc32 (as text) has remainder ``part``; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))


def windows_of(raw: bytes) -> list[bytes]:
    """``raw`` cut into windows of equal length; the last one ends with the text, a short text is padded."""
    if len(raw) <= WINDOW:
        return [raw.ljust(WINDOW, b"\0")]
    starts = [*range(0, len(raw) - WINDOW, WINDOW), len(raw) - WINDOW]
    return [raw[s : s + WINDOW] for s in starts]


class Network:
    """Byte vectors, filters of several widths, rectifier, maximum over the window, softmax."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        scale = lambda *s: rng.normal(0, 1 / np.sqrt(np.prod(s[:-1])), s).astype(np.float32)
        self.params = {"emb": rng.normal(0, 0.5, (256, VECTOR)).astype(np.float32)}
        for w in WIDTHS:
            self.params[f"k{w}"] = scale(w, VECTOR, FILTERS)
            self.params[f"b{w}"] = np.zeros(FILTERS, np.float32)
        self.params["out"] = scale(FILTERS * len(WIDTHS), len(languages))
        self.params["bias"] = np.zeros(len(languages), np.float32)

    def tables(self) -> None:
        """What each byte and each pair of bytes adds to the filters, so that a filter is a few lookups."""
        p = self.params
        one = {(w, j): p["emb"] @ p[f"k{w}"][j] for w in WIDTHS for j in range(w)}
        self.one = one
        self.two = {(w, j): (one[w, j][:, None] + one[w, j + 1][None]).reshape(65536, FILTERS) for w in WIDTHS for j in range(0, w - 1, 2)}

    def pooled(self, x: np.ndarray) -> np.ndarray:
        pair = x[:, :-1].astype(np.int32) << 8 | x[:, 1:]
        found = []
        for w in WIDTHS:
            n = x.shape[1] - w + 1
            sums = None
            for j in range(0, w, 2):
                part = self.two[w, j][pair[:, j : j + n]] if j + 1 < w else self.one[w, j][x[:, j : j + n]]
                sums = part if sums is None else np.add(sums, part, out=sums)
            found.append(np.maximum(sums.max(axis=1) + self.params[f"b{w}"], 0))
        return np.concatenate(found, axis=1)

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        z = self.pooled(x) @ self.params["out"] + self.params["bias"]
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, grads = self.params, {}
        rows, pools, places = np.arange(len(x))[:, None], [], []
        for w in WIDTHS:
            n = x.shape[1] - w + 1
            sums = sum((p["emb"] @ p[f"k{w}"][j])[x[:, j : j + n]] for j in range(w))
            at = sums.argmax(axis=1)
            places.append(at)
            pools.append(np.take_along_axis(sums, at[:, None], axis=1)[:, 0] + p[f"b{w}"])
        hidden = np.maximum(np.concatenate(pools, axis=1), 0)
        z = hidden @ p["out"] + p["bias"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        z /= z.sum(axis=1, keepdims=True)
        z[np.arange(len(y)), y] -= 1
        z /= len(y)
        grads["out"], grads["bias"] = hidden.T @ z, z.sum(axis=0)
        back = (z @ p["out"].T) * (hidden > 0)
        grads["emb"] = np.zeros_like(p["emb"])
        for i, w in enumerate(WIDTHS):
            d = back[:, i * FILTERS : (i + 1) * FILTERS]
            grads[f"b{w}"] = d.sum(axis=0)
            grads[f"k{w}"] = np.zeros_like(p[f"k{w}"])
            for j in range(w):
                seen = x[rows, places[i] + j]
                grads[f"k{w}"][j] = np.einsum("bf,bfe->ef", d, p["emb"][seen])
                np.add.at(grads["emb"], seen, d[:, :, None] * p[f"k{w}"][j].T[None])
        return grads

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01) -> None:
        rng = np.random.default_rng(1)
        first = {k: np.zeros_like(v) for k, v in self.params.items()}
        second = {k: np.zeros_like(v) for k, v in self.params.items()}
        step = 0
        steps = max(300, epochs * -(-len(x) // batch))  # few windows are seen more often
        while step < steps:
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                part = order[at : at + batch]
                step += 1
                slow = rate * (1 - step / (steps + 1))
                for k, g in self.gradients(x[part], y[part]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                    self.params[k] = (self.params[k] - slow * move).astype(np.float32)
                if step >= steps:
                    break


def as_windows(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw).lower(), np.uint8).reshape(-1, WINDOW)


def train(
    labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE, windows_per_row: int = WINDOWS_PER_ROW,
) -> Network | None:
    """A network fitted on a bounded sample of ``labelled``: at most ``rows_per_language`` rows of each
    language, drawn by a hash of the key, and ``windows_per_row`` windows of each, at places over the whole
    text; every epoch sees all of them. None if there is no row with text and language.

    A language's rows are counted first, and hashes above ``SPARE`` times the share that is wanted are left out where
    they are read, so that some thousand rows of a language meet, however many it has."""
    drawn = F.row_number().over(Window.partitionBy("lang").orderBy("_draw"))
    counts = settled(labelled.groupBy(F.col(lang).alias("_lang")).agg(F.count("*").alias("_rows")))
    if counts.count() <= BROADCAST_LANGUAGES:
        counts = F.broadcast(counts)
    # of 64 bits, from the lowest value on
    highest = F.least(F.lit(1.0), F.lit(float(SPARE * rows_per_language)) / F.col("_rows")) * 2.0**64 - 2.0**63
    span = F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1
    starts = [(F.pmod(F.xxhash64(F.lit(i), "_draw"), span) + 1).cast("int") for i in range(windows_per_row)]
    given = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(key)).alias("_draw"))
    given = given.filter("lang is not null and text is not null").join(counts, F.col("lang") == F.col("_lang"))
    given = given.filter(F.col("_draw").cast("double") <= highest).filter("text rlike '\\\\p{L}'").select(
        "lang", "_draw", F.array(*(F.substring("text", s, F.lit(WINDOW)) for s in starts)).alias("texts")
    )
    sample = given.withColumn("_n", drawn).filter(F.col("_n") <= rows_per_language).select("lang", "texts", "_draw")
    rows = sorted(sample.collect(), key=lambda r: (r["lang"], r["_draw"], r["texts"]))
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    place = {x: i for i, x in enumerate(languages)}
    found = [(windows_of(t.encode())[0], place[r["lang"]]) for r in rows for t in r["texts"]]
    network = Network(languages)
    if len(languages) > 1:
        network.fit(as_windows([f[0] for f in found]), np.array([f[1] for f in found]))
    return network


LETTER = regex.compile(r"\p{L}")


def classify(texts: list[str | None], network: Network | None, chunk: int = 256) -> tuple[list[str], list[float]]:
    """Language and score of each whole text: windows' log probabilities, weighted by their letters, averaged."""
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if network is None:
        return names, scores
    raw, owner = [], []
    for i, t in enumerate(texts):
        if t and LETTER.search(t):
            own = windows_of(t.encode())
            raw += own
            owner += [i] * len(own)
    if not raw:
        return names, scores
    x, owner = as_windows(raw), np.array(owner)
    # bytes over 127 and ASCII letters; a little for any, since a text has a letter somewhere
    weight = ((x >= 128) | ((x >= 97) & (x <= 122))).sum(axis=1) + 1e-3
    logs = np.concatenate([network.log_probs(x[at : at + chunk]) for at in range(0, len(x), chunk)])
    total, weights = np.zeros((len(texts), logs.shape[1])), np.zeros(len(texts))
    np.add.at(total, owner, logs * weight[:, None])
    np.add.at(weights, owner, weight)
    for i in np.flatnonzero(weights):
        z = total[i] / weights[i]
        p = np.exp(z - z.max())
        best = int(z.argmax())
        names[i], scores[i] = network.languages[best], float(p[best] / p.sum())
    return names, scores


def identify(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score``; other columns stay.

    A null text, an empty one or one without letters is ``und`` with score 0, and so is every text if there
    was nothing to learn from. Whole texts of any length; equal texts get equal results; an empty table
    gives no rows. A column of the same name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)  # some ten thousand numbers
    kept = docs.drop("lang_pred", "lang_score")
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        if network is not None:
            network.tables()
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                names, scores = classify(part.column(at).to_pylist(), network)
                arrays = [*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, "lang_pred", "lang_score"])

    schema = StructType([*kept.schema, StructField("lang_pred", StringType()), StructField("lang_score", DoubleType())])
    return kept.mapInArrow(run, schema)


def predict(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", **bounds) -> DataFrame:
    """Per document: ``doc_id``, ``held_out``, ``lang_pred`` and ``score``. Learned from the documents that aren't held out
    (crc32 of the key as text, remainder 0 by 5, is held out; a null key is neither held out nor learned from)."""
    learn = docs.filter(F.col(key).isNotNull() & ~held_out(F.col(key)))
    network = train(learn, key, text, lang, **bounds)
    given = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    found = identify(given, network)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


#: Below this score the pipeline rejects a document.
LEAST_SCORE = 0.4


def known_language(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of ``least`` or more; columns as given."""
    learn = docs.filter(F.col(key).isNotNull() & ~held_out(F.col(key)))
    network = train(learn, key, text, lang)
    boxed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(text).alias("_text"))
    found = identify(boxed, network, "_text")
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("lang_score") >= least)).select("_row.*")
