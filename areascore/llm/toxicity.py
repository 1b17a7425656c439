"""Toxicity of a text after undoing leetspeak, spacing and repetition with a character language model."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from areascore.llm.common import settled
from areascore.llm.langid import held_out

#: Letters that a sign may stand for. Fixed values.
LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou", "#": "aeiou",
}
#: Signs that may stand between the letters of a spaced word. Fixed values.
SPACERS = " .-_*,'"
#: Cost of the channel, in nats: a sign for a letter, a letter doubled, a letter repeated more often.
SIGN_COST, DOUBLE_COST, RUN_COST = 1.0, 0.7, 0.2
#: Letters of the model: a to z, the letters of Latin-1, and one place for all else, which is also the word's edge.
LETTERS = "".join([chr(c) for c in range(97, 123)] + [chr(c) for c in [*range(223, 247), *range(248, 256)]])
SIZE = len(LETTERS) + 1
#: Bounds: labelled rows that are learned from, features of the model, words that a worker remembers.
SAMPLE_ROWS, MAX_FEATURES, REMEMBERED = 20_000, 20_000, 200_000
#: A feature stands in this many toxic documents of the sample at least, and weighs this much at least.
LEAST_TOXIC, LEAST_WEIGHT = 3, 1.0
#: Evidence above these values counts as much as they do, so that long texts don't outweigh what single words say.
MOST_TOTAL, MOST_DENSE = 30.0, 5.0
#: Lengths of the beginnings of words that count as features of their own.
STEMS = (4, 5)
#: What is cut from a token's ends before it is read as a hidden word. Fixed value.
EDGES = ".,;:!?\"'()[]{}<>*#%&=/\\-_~^`|"
LEAST_SCORE = 0.3

_APART = r"(?:[^\W\d_]|[" + re.escape("".join(LEET)) + r"])(?![^\W_])"
_MARKS = re.escape(SPACERS.replace(" ", ""))
#: What may stand between spaced letters: white space or spacers of any width, also a spacer in white space.
_GAP = rf"(?>\s++(?={_APART})|[{_MARKS}]++(?={_APART})|\s*+[{_MARKS}]++\s*+)"
#: Three or more letters or signs, each set apart; which of the gaps are edges of words is left to the search.
SPACED = re.compile(rf"(?<![^\W_])(?<![^\W_][{_MARKS}]){_APART}(?:{_GAP}{_APART}){{2,}}+")
GAPS = re.compile(rf"({_APART})(?:{_GAP}(?={_APART}))?")
REPEATED = re.compile(r"([^\W\d_])\1\1")
WORDS = re.compile(r"[^\W\d_]+")
HIDDEN = re.compile(r"[^\W\d_]")

_CLASS = np.zeros(65536, np.int64)
for _i, _c in enumerate(LETTERS):
    _CLASS[ord(_c)] = _i + 1


def trigrams(texts: list[str]) -> np.ndarray:
    """Counts of all runs of three places in the lower-case texts, each between edges."""
    joined = ("\n".join(texts).lower() + "\n").encode("utf-16-le", "replace")
    c = _CLASS[np.frombuffer(joined, np.uint16)]
    c = np.concatenate([[0, 0], c])
    return np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE**3)


class Model:
    """What scoring needs: character log probabilities, weights of words and stems, and the regression on them."""

    def __init__(self, chars: np.ndarray, weights: dict[str, float] | None = None):
        self.chars, self.weights = chars, weights
        self.slope, self.offset = np.zeros(3), 0.0
        self.tokens = Tokens(self)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.slope + self.offset, -30, 30)))


class Tokens(dict):
    """token -> its features, those with a weight if the model has weights. Remembers a bounded number of
    tokens and starts anew when full."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __reduce__(self):
        return Tokens, (self.model,)

    def __missing__(self, token: str) -> tuple[str, ...]:
        found = set(WORDS.findall(token))
        inner = token.strip(EDGES)
        if REPEATED.search(inner) or (not inner.isalpha() and HIDDEN.search(inner)):
            found.add(restore(inner, self.model.chars))
        for n in STEMS:
            found |= {f"{w[:n]}-" for w in found if len(w) > n and w[-1] != "-"}
        weights = self.model.weights
        out = tuple(found) if weights is None else tuple(found & weights.keys())
        if len(token) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[token] = out
        return out


def char_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """log P(letter | two before) from the trigrams of all whole texts, smoothed by the letter's share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                total += trigrams(batch.column(0).slice(at, 256).to_pylist())
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["gram", "n"])

    grams = docs.filter(F.col(text).isNotNull()).select(F.col(text).alias("text")).mapInArrow(run, "gram int, n long")
    counts = np.zeros(SIZE**3)
    for row in grams.groupBy("gram").agg(F.sum("n").alias("n")).collect():  # at most SIZE^3 rows
        counts[row["gram"]] = row["n"]
    counts = counts.reshape(SIZE, SIZE, SIZE)
    share = (counts.sum(axis=(0, 1)) + 1) / (counts.sum() + SIZE)
    return np.log((counts + 5 * share) / (counts.sum(axis=2, keepdims=True) + 5))


def lattice(shown: str) -> list[list[tuple[str, float]]]:
    """For each run of equal characters of ``shown``: the strings it may have been, and their cost."""
    out = []
    for run in re.finditer(r"(.)\1*", shown, re.S):
        char, n = run[1], len(run[0])
        letters = [(char, 0.0)] if char.isalpha() else []
        letters += [(x, SIGN_COST) for x in LEET.get(char, "")]
        if not letters:
            letters = [("", 0.0)]
        options = []
        for x, cost in letters:
            options.append((x, cost + (RUN_COST if n > 2 else DOUBLE_COST if n == 2 and x else 0.0)))
            if n >= 2 and x:
                options.append((x + x, cost + (RUN_COST + DOUBLE_COST if n > 2 else 0.0)))
        out.append(options)
    return out


def restore(shown: str, chars: np.ndarray) -> str:
    """The most probable word behind ``shown``."""
    return search(lattice(shown), chars)


def spaced_words(shown: str, chars: np.ndarray) -> list[str]:
    """The most probable words behind letters set apart: each gap is an edge of words or nothing, and of three
    or more equal letters some may go."""
    letters = [m[1] for m in GAPS.finditer(shown)]
    same = [len(run[0]) for run in re.finditer(r"(.)\1*", "".join(letters), re.S)]
    sizes = [(n, i) for n in same for i in range(n)]
    steps = []
    for letter, (n, i) in zip(letters, sizes):
        options = lattice(letter)[0]
        if i and n > 2:
            options = [*options, ("", RUN_COST)]
        if steps:
            steps.append([("", 0.0), (" ", 0.0)])
        steps.append(options)
    return search(steps, chars).split()


def search(steps: list[list[tuple[str, float]]], chars: np.ndarray) -> str:
    """The most probable string through ``steps``: Viterbi with the last two letters as state; a space is an edge."""
    paths: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for options in steps:
        new: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (cost, word) in paths.items():
            for add, extra in options:
                x, y, total = a, b, cost + extra
                for c in add:
                    k = int(_CLASS[ord(c)]) if ord(c) < 65536 else 0
                    total -= chars[x, y, k]
                    x, y = y, k
                if (x, y) not in new or total < new[x, y][0]:
                    new[x, y] = (total, (word, add))
        paths = new
    _, last = min((cost - chars[a, b, 0], word) for (a, b), (cost, word) in paths.items())
    parts = []
    while last:
        last, add = last
        parts.append(add)
    return "".join(reversed(parts))


def features(text: str | None, model: Model) -> tuple[set[str], int]:
    """Distinct features of the whole text and of what it hides, and the number of its distinct tokens."""
    text = (text or "").lower()
    tokens = set(text.split())
    for m in SPACED.finditer(text):
        if HIDDEN.search(m[0]):
            tokens.update(spaced_words(m[0], model.chars))
            tokens.add("".join(GAPS.findall(m[0])))  # one word, should the search have split it
    return set().union(*map(model.tokens.__getitem__, tokens)), len(tokens)


def evidence(text: str | None, model: Model) -> tuple[float, float, float]:
    """Largest weight, sum of the weights, and that sum by the root of the number of tokens."""
    found, n = features(text, model)
    values = [model.weights[f] for f in found]
    total = sum(sorted(values))
    return max(values, default=0.0), min(total, MOST_TOTAL), min(total / max(1, n) ** 0.5, MOST_DENSE)


def regression(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's steps with a small penalty."""
    z = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(z.shape[1]), np.diag([*[0.05] * x.shape[1], 0.01])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = z.T @ (z * (p * (1 - p) + 1e-6)[:, None]) + penalty
        w = w + np.linalg.solve(h, z.T @ (y - p) - penalty @ w)
    return w[:-1], float(w[-1])


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Learn from about ``sample_rows`` labelled rows at most, drawn by a hash of the key; characters come from all
    texts of ``docs``.

    Three quarters of the sample give the weights of words and stems (log odds of their documents, held back by
    ten documents that are as toxic as the rest), the last quarter the regression on them. The ``MAX_FEATURES`` heaviest features of
    ``LEAST_TOXIC`` toxic documents and ``LEAST_WEIGHT`` make the model. A document with
    several labels counts as toxic if one says so.
    """
    model = Model(char_model(docs, text))
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("_id")).agg(F.max(label).cast("int").alias("y"))
    rows = known.count()
    hashed = F.xxhash64(F.lit(3), "_id")
    drawn = known.withColumn("_draw", F.pmod(hashed, F.lit(1_000_000)))
    if rows > sample_rows:  # of 63 bits, so that a share is drawn however small it is
        drawn = drawn.filter(F.shiftrightunsigned(hashed, 1) < int(2**63 * (sample_rows / rows)))
    sample = settled(
        docs.select(F.col(key).alias("_key"), F.col(text).alias("text"))
        .join(F.broadcast(drawn), F.col("_key") == F.col("_id"))  # the sample's bound
        .select("text", "y", (F.pmod("_draw", F.lit(4)) < 3).alias("counts"))
    )
    context = docs.sparkSession.sparkContext
    first = context.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ys = part.column(1).to_pylist()
                n, toxic = Counter({"": len(ys)}), Counter({"": sum(ys)})
                for t, y in zip(part.column(0).to_pylist(), ys):
                    found = features(t, first.value)[0]
                    n.update(found)
                    if y:
                        toxic.update(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*n], pa.string()), pa.array([*n.values()], pa.int64()), pa.array([toxic[k] for k in n], pa.int64())],
                    names=["feature", "n", "toxic"],
                )

    counted = sample.filter("counts").select("text", "y").mapInArrow(count, "feature string, n long, toxic long")
    counted = settled(counted.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")))
    whole = counted.filter("feature = ''").first()
    if whole is None or not 0 < whole["toxic"] < whole["n"]:
        model.weights = {}
        model.offset = -3.0 if whole is None or not whole["toxic"] else 3.0
        return model
    share = whole["toxic"] / whole["n"]
    weight = F.log((F.col("toxic") + 10 * share) / (F.col("n") - F.col("toxic") + 10 * (1 - share))) - float(
        np.log(share / (1 - share))
    )
    best = counted.filter((F.col("feature") != "") & (F.col("toxic") >= LEAST_TOXIC)).select("feature", weight.alias("w")).filter(F.col("w") >= LEAST_WEIGHT)
    best = best.orderBy(F.desc("w"), "feature").limit(MAX_FEATURES)
    model.weights = {r["feature"]: r["w"] for r in best.collect()}
    second = context.broadcast(model)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([evidence(t, second.value) for t in batch.column(0).to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*map(pa.array, found.T), batch.column(1)], names=["a", "b", "c", "y"])

    rest = sample.filter("not counts").select("text", "y").mapInArrow(weigh, "a double, b double, c double, y int")
    seen = np.array(sorted(tuple(r) for r in rest.collect()), dtype=float).reshape(-1, 4)
    model.slope, model.offset = regression(seen[:, :3], seen[:, 3])
    model.tokens = Tokens(model)
    return model


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """Per document: ``doc_id``, ``score`` (0 to 1) and ``predicted`` (1 from ``least`` on).

    A null or empty text has no evidence and gets the score of that. Whole texts of any length, read once;
    equal texts get equal scores; repeated rows come back as often; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_FEATURES and SIZE^3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = model.score(np.array([evidence(t, model) for t in part.column(1).to_pylist()]))
                arrays = [part.column(0), pa.array(found), pa.array((found >= least).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "score", "predicted"])

    given = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([given.schema["doc_id"], StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return given.mapInArrow(run, schema)


def predict(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``score`` for all ``docs``, with ``held_out``: labels of keys whose crc32 has remainder 2 by 4 aren't learned from."""
    model = train(docs, labels.filter(~held_out(F.col(key), 4, 2)), key, text, **options)
    return score(docs, model, key, text).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted"
    )
