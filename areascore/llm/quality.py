"""Quality rules: repetition, and the divergence of a text from its language."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areascore.llm.common import settled

#: Characters that count as symbols. Fixed value.
SYMBOLS = "#*$%&|<>"
#: Classes of the characters in words; all others are one more class. Fixed values.
CLASSES = {
    "vowels": "aeiouAEIOU", "consonants": "bcdfghjklmnpqrstvwxyzBCDFGHJKLMNPQRSTVWXYZ", "digits": "0123456789",
    "punctuation": ".,;:!?'\"()-", "symbols": SYMBOLS + "@=+/\\_~^`{}[]",
}
#: The sign that stands for a character while its class is counted: one for each class, upper case apart, and
#: the contract's symbols apart.
_SIGNS = {"v": "aeiou", "V": "AEIOU", "k": "bcdfghjklmnpqrstvwxyz", "K": "BCDFGHJKLMNPQRSTVWXYZ", "0": "0123456789",
          ".": CLASSES["punctuation"], "#": SYMBOLS, "@": CLASSES["symbols"][len(SYMBOLS):]}
_BY_FREQUENCY = "kv.VK0#@"
_OF = {"vowels": "vV", "consonants": "kK", "digits": "0", "punctuation": ".", "symbols": "#@", "upper": "VK"}
#: Words that a repeated run has.
RUN = 5
#: Common words of a language that are compared.
COMMON = 32
#: Limits of the two distances, and the words that a text has at least for them to count. A text without any of the
#: common words has a word distance of 0.38 to 0.39 in the given languages, whose common words hold 26-27% of all.
CHAR_LIMIT, CHAR_WORDS = 0.35, 30
WORD_LIMIT, WORD_WORDS = 0.36, 50
#: Languages up to which their references are broadcast, some kilobytes each.
BROADCAST_LANGUAGES = 10_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]++"), F.lit(0))


def signs(text: Column) -> Column:
    """``text`` without space, each ASCII character replaced by the sign of its class."""
    # what has no sign is taken out
    return F.translate(text, "".join(_SIGNS.values()) + " \t\n\x0b\x0c\r", "".join(c * len(v) for c, v in _SIGNS.items()))


def n_sign(coded: str, sign: str) -> Column:
    return F.octet_length(coded) - F.octet_length(F.replace(F.col(coded), F.lit(sign), F.lit("")))


def _counted(sign: str) -> str:
    return f"sign_{ord(sign)}"


def n_class(name: str) -> Column:
    """Characters of a class, from the counts of its signs."""
    return reduce(lambda a, b: a + b, (F.col(_counted(c)) for c in _OF[name])).alias(name)


def repeat_words(ranked: str) -> Column:
    """Words that stand in a run found twice: sorted by hash, a run's like is next to it; what the runs' places
    cover, in order, counts once."""
    like = lambda x, i: (F.get(ranked, i - 1)["g"] == x["g"]) | (F.get(ranked, i + 1)["g"] == x["g"])
    places = F.array_sort(F.transform(F.filter(ranked, lambda x, i: F.coalesce(like(x, i), F.lit(False))), lambda x: x["i"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(-RUN).alias("last"))
    step = lambda a, p: F.struct((a["n"] + F.least(F.lit(RUN), p - a["last"])).alias("n"), p.alias("last"))
    return F.aggregate(places, start, step, lambda a: a["n"])


def measures(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """Each text in lower case, the contract's counts and the class counts, all inside its row."""
    full = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(lang).cast("string").alias("lang"), full.alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text")))
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    n = F.size("words")
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn("pairs", F.when(n >= RUN, F.zip_with(F.slice("hashes", 1, n - 1), F.slice("hashes", 2, n - 1), _both)).otherwise(none))
    rows = rows.withColumn("fours", F.when(n >= RUN, F.zip_with(F.slice("pairs", 1, n - 3), F.slice("pairs", 3, n - 3), _both)).otherwise(none))
    rows = rows.withColumn("grams", F.when(n >= RUN, F.zip_with(F.slice("fours", 1, n - 4), F.slice("hashes", 5, n - 4), _both)).otherwise(none))
    twice = F.size(F.array_distinct("grams")) < F.size("grams")
    numbered = F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    rows = rows.withColumn("ranked", F.when(twice, numbered))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("lines", lines).withColumn("coded", signs(F.col("text")))
    # sign after sign is taken out, the frequent ones first, and each counts as the bytes that go
    chain = ["coded", *(f"without_{ord(c)}" for c in _BY_FREQUENCY)]
    for c, before, after in zip(_BY_FREQUENCY, chain, chain[1:]):
        rows = rows.withColumn(after, F.replace(F.col(before), F.lit(c), F.lit("")))
    gone = dict(zip(_BY_FREQUENCY, zip(chain, chain[1:])))
    rows = rows.select(
        "doc_id", "lang", F.lower("text").alias("lower"), n.cast("long").alias("n_words"),
        F.length("coded").cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeat_words("ranked"), F.lit(0)).cast("long").alias("n_repeat_words"),
        *((F.octet_length(gone[c][0]) - F.octet_length(gone[c][1])).alias(_counted(c)) for c in _SIGNS),
    )
    kept = ["doc_id", "lang", "lower", "n_words", "word_chars", "n_dup_lines", "n_repeat_words"]
    return rows.select(*kept, F.col(_counted("#")).cast("long").alias("n_symbols"), *map(n_class, _OF))


def _both(p: Column, q: Column) -> Column:
    return F.xxhash64(p, q)


def references(docs: DataFrame, text: str, lang: str, common: int = COMMON) -> DataFrame:
    """Per language, and for all texts together (null): its ``common`` most frequent words with their shares, and the
    shares of the character classes, counted over all words of all documents."""
    words = docs.select(F.col(lang).cast("string").alias("lang"), F.explode(words_of(F.col(text))).alias("word"))
    counted = settled(words.groupBy("lang", "word").agg(F.count("*").alias("n")))
    pooled = counted.groupBy("word").agg(F.sum("n").alias("n"))
    every = counted.filter("lang is not null").select("lang", "word", "n", F.lit(False).alias("pooled")).union(
        pooled.select(F.lit("").alias("lang"), "word", "n", F.lit(True).alias("pooled"))
    )
    coded = every.withColumn("coded", signs(F.col("word")))
    sums = coded.groupBy("lang", "pooled").agg(
        F.sum("n").alias("all_words"), F.sum(F.col("n") * F.length("word")).alias("chars"),
        *(F.sum(F.col("n") * n_sign("coded", c)).alias(_counted(c)) for c in _SIGNS),
    ).select("lang", "pooled", "all_words", "chars", *map(n_class, _OF))
    every = every.groupBy("lang", "pooled", F.lower("word").alias("word")).agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang", "pooled").orderBy(F.desc("n"), "word"))
    top = every.withColumn("place", place).filter(F.col("place") <= common).groupBy("lang", "pooled").agg(
        F.sort_array(F.collect_list(F.struct("place", "word", "n"))).alias("top")  # at most ``common``
    )
    shares = F.transform("top", lambda x: x["n"] / F.col("all_words"))
    classes = F.array(*(F.col(c) / F.col("chars") for c in [*CLASSES, "upper"]))
    return sums.join(top, ["lang", "pooled"]).select(
        F.col("lang").alias("ref_lang"), F.col("pooled").alias("ref_pooled"),
        F.transform("top", lambda x: x["word"]).alias("ref_words"), shares.alias("ref_shares"), classes.alias("ref_classes"),
    )


def js_distance(p: Column, q: Column) -> Column:
    """Root of the Jensen-Shannon divergence (to base 2) of two arrays of shares; what lacks to 1 is one more share."""
    term = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    half = lambda a, b: (term(a, (a + b) / 2) + term(b, (a + b) / 2)) / 2
    total = lambda x: F.greatest(F.lit(0.0), 1 - F.aggregate(x, F.lit(0.0), lambda s, v: s + v))
    listed = F.aggregate(F.zip_with(p, q, half), F.lit(0.0), lambda s, v: s + v)
    return F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), listed + half(total(p), total(q)))))


def _letters(common: int) -> list[str]:
    """A letter of two bytes for each place of a list."""
    return [chr(256 + i) for i in range(common)]


def coded_words(lower: str, listed: str, common: int) -> Column:
    """One letter for each word of a lower-cased text that is ``listed``, that of its place. The list is one expression, compiled
    once as long as it stays, so that only listed words are looked up."""
    quoted = F.transform(listed, lambda w: F.concat(F.lit(r"\Q"), F.replace(w, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")))
    one = F.concat(F.lit(r"(?<![^\x20\x09-\x0D])(?:"), F.array_join(quoted, "|"), F.lit(r")(?![^\x20\x09-\x0D])"))
    own = F.regexp_extract_all(F.col(lower), one, F.lit(0))
    place = lambda w: F.array_position(listed, w).cast("int")
    return F.array_join(F.transform(own, lambda w: F.substr(F.lit("".join(_letters(common))), place(w), F.lit(1))), "")


def letter_shares(coded: str, n_words: str, listed: str, common: int) -> Column:
    """Share of each of the ``listed`` words, counted by its letter."""
    without = lambda c: F.octet_length(F.replace(F.col(coded), F.lit(c), F.lit("")))
    shares = [(F.octet_length(coded) - without(c)) / 2 / F.col(n_words) for c in _letters(common)]
    return F.when(F.col(listed).isNotNull(), F.slice(F.array(*shares), F.lit(1), F.size(listed)))


def assess(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", common: int = COMMON,
    char_limit: float = CHAR_LIMIT, char_words: int = CHAR_WORDS, word_limit: float = WORD_LIMIT, word_words: int = WORD_WORDS,
) -> DataFrame:
    """One row per document with the counts, ``base_failed``, the two distances and ``kept``.

    ``char_distance`` compares the classes of the text's characters, ``word_distance`` its most common words, with the
    document's language (all documents where that is null), counted over all documents. A text that
    passes the base rules is kept unless a distance is over its limit; texts with fewer words than the
    distance's guard aren't judged by it, since short texts diverge by chance. Distances are null without words.

    A null text has no words and fails; whole texts of any length; repeated rows come back as often; an
    empty table gives no rows; other columns are ignored. Equal 64-bit hashes count as equal runs.
    """
    rows = measures(docs, key, text, lang)
    refs = settled(references(docs, text, lang, common))
    if refs.count() <= BROADCAST_LANGUAGES:
        refs = F.broadcast(refs)
    rows = rows.withColumn("_pooled", F.col("lang").isNull()).withColumn("_lang", F.coalesce("lang", F.lit("")))
    rows = rows.join(refs, (F.col("_lang") == F.col("ref_lang")) & (F.col("_pooled") == F.col("ref_pooled")), "left")
    has = F.col("n_words") > 0
    rows = rows.withColumn("_coded", F.when(has, coded_words("lower", "ref_words", common)))
    rows = rows.withColumn("_found", F.when(has, letter_shares("_coded", "n_words", "ref_words", common)))
    own = F.array(*(F.col(c) / F.col("word_chars") for c in CLASSES))
    # upper case is a part of the letters: its share and the rest's are compared on their own
    upper = F.array(F.col("upper") / F.col("word_chars"))
    rows = rows.withColumn("char_distance", F.when(has, F.greatest(
        js_distance(own, F.slice("ref_classes", 1, len(CLASSES))),
        js_distance(upper, F.slice("ref_classes", len(CLASSES) + 1, 1)),
    )))
    rows = rows.withColumn("word_distance", F.when(has, js_distance(F.col("_found"), F.col("ref_shares"))))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    strange = ((F.col("n_words") >= char_words) & (F.col("char_distance") > char_limit)) | (
        (F.col("n_words") >= word_words) & (F.col("word_distance") > word_limit)
    )
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        (~base & ~F.coalesce(strange, F.lit(False))).alias("kept"), "char_distance", "word_distance",
    )
