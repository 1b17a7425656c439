"""Personal data: base patterns, and candidates that boosted trees accept. DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds that the base finds, and all kinds, in the order of the spans.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")

# The base patterns, written so that a long run of characters is tried once: a run is entered at its start
# only (or where the last match ended), and no part gives characters back that the next part can't use.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text needs at least for a kind.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

#: Generators of candidates: (kind, hint, pattern). They overlap one another and the base on purpose.
GENERATORS = (
    ("email", "@", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("email", r"(?i)[(\[]at[)\]]|\Wat\W.*\Wdot\W", r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]|(?<= )at(?= )) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]|(?<= )dot(?= )) ?[A-Za-z0-9-]++)++"),
    ("ip", r"[0-9]\.[0-9]", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"),
    ("card", r"[0-9]{12}", r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    ("card", r"[0-9]{4}[ -][0-9]{4}", r"(?<![0-9])[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}(?![0-9])"),
    ("phone", r"\+[0-9]", r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"),
    ("phone", r"[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    ("secret", r"(?i)(?:token|passw|secret|key)[a-z_]*+\W{1,4}+[a-z0-9_+/-]{16}", r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/-]{16,}+={0,2}+(?![A-Za-z0-9_+/=-])"),
)
#: Places of the generators that find what the base can't: hidden e-mails, and phones without a country.
HIDDEN, PLAIN_PHONE = 1, 6
#: What stands for @ and for a dot in hidden e-mails. Fixed values.
AT, DOT = r"(?i) ?[(\[]at[)\]] ?| at ", r"(?i) ?[(\[]dot[)\]] ?| dot "
#: Words before a candidate that speak for a secret or for an address. Fixed values.
SECRET = r"(?i)(?:token|password|passwd|secret|key|hash|sha|md5|uuid|id|=|:|\")[ =:\"']*$"
CONTACT = r"(?i)(?:mail|e-mail|contact|call|phone|tel|fax|mobile|card|visa|ip|host|server|address)[a-z.]*[ =:]*$"
#: What makes the value behind it a secret, and a number behind it a version. Fixed values.
ASSIGNED = r"(?i)(?:token|passw|secret|key)[a-z_]*['\"]?[ =:]+['\"]?$"
VERSION = r"(?i)(?:\bv|version|release|build)[ .:]*$"
#: Characters around a candidate that context features see.
AROUND = 24

#: Features and the number of values of each: the grid bounds the table that the trees are fitted on.
FEATURES = {"gen": len(GENERATORS), "digits": 5, "before": 4, "after": 4, "secret": 2, "contact": 2, "version": 2, "parted": 2, "signed": 2}
#: Trees, their rate, the share of personal data that accepted candidates must reach, and the least score of any.
TREES, RATE, PRECISION, FLOOR = 30, 0.3, 0.9, 0.8
#: One of so many documents is held back from the trees, for the thresholds.
HELD = 4


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]+", "")


def luhn(found: Column) -> Column:
    """Whether the digits of ``found`` sum up by Luhn's rule."""
    own = F.split(F.reverse(digits(found)), "")
    value = F.transform(own, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), d.cast("int") + 1)))
    return F.aggregate(value, F.lit(0), lambda s, v: s + F.coalesce(v, F.lit(0))) % 10 == 0


def passes(kind: str, found: Column) -> Column:
    """The base rule of ``kind`` for a match."""
    n = F.length(digits(found))
    return {
        "email": F.lit(True),
        "ip": found.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        "card": n.between(16, 19) & luhn(found),
        "phone": n.between(8, 15),
    }[kind]


def normalised(kind: str, found: Column) -> Column:
    """A candidate as the base rule of its kind reads it: hidden e-mails with their @ and dots, cards as digits."""
    if kind == "email":
        return F.regexp_replace(F.regexp_replace(found, AT, "@"), DOT, ".")
    return digits(found) if kind == "card" else found


def plausible(gen: int, kind: str, found: Column, context: dict[str, Column]) -> Column:
    """What the trees learn from, as no table marks personal data: the base rule holds for the normalised candidate,
    and its context speaks for it where the form alone doesn't."""
    plain = normalised(kind, found)
    if kind == "secret":
        return found.rlike("[0-9]") & found.rlike("[A-Za-z]") & context["assigned"]
    if kind == "email":
        valid = plain.rlike(rf"^[{_LOCAL}]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$")
        return valid & (context["contact"] | found.rlike(r"[(\[]")) if gen == HIDDEN else valid
    rule = passes(kind, plain)
    if kind == "card":
        n = F.length(plain)
        rule = n.between(13, 19) & luhn(plain) & ~context["assigned"]
    if kind == "ip":
        rule = rule & ~context["version"]
    return rule & context["contact"] if gen == PLAIN_PHONE else rule


def matches(df: DataFrame, wanted: list[tuple[str, str, str]]) -> DataFrame:
    """``df`` (with ``text``) and for each (name, hint, pattern) a column of the matches in order: start and end in
    code points, and the match itself. A text without the hint isn't searched.

    The pieces between the matches give the places; places add up along the array.
    """
    none = F.array().cast("array<string>")
    for name, hint, pattern in wanted:
        may = F.col("text").rlike(hint)
        df = df.withColumn(f"_m_{name}", F.when(may, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    for name, _, pattern in wanted:
        has = F.size(f"_m_{name}") > 0
        df = df.withColumn(f"_p_{name}", F.when(has, F.split("text", pattern, -1)).otherwise(none))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,m:string>>").alias("out"))
    made = []
    for name, _, _ in wanted:
        made.append(F.aggregate(F.arrays_zip(F.col(f"_p_{name}").alias("p"), F.col(f"_m_{name}").alias("m")), start, _place, lambda a: a["out"]).alias(name))
    kept = [c for c in df.columns if c[:3] not in ("_m_", "_p_")]
    return df.select(*kept, *made)


def _place(a: Column, x: Column) -> Column:
    s = a["at"] + F.length(x["p"])
    e = s + F.length(x["m"])
    found = F.concat(a["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m"))))
    return F.when(x["m"].isNull(), a).otherwise(F.struct(e.alias("at"), found.alias("out")))


def _char_class(c: Column) -> Column:
    """0 none or white space, 1 letter or digit, 2 closing punctuation, 3 other."""
    return F.when(c.rlike(r"^[\p{L}\p{N}]$"), 1).when(c.isin(*".,;:!?)\"'"), 2).when((c == "") | c.rlike(r"^\s$"), 0).otherwise(3)


def candidates(rows: DataFrame) -> DataFrame:
    """``rows`` with ``found``: the candidates of all generators with place, generator, kind's base spans and features."""
    gens = [_listed(i, kind) for i, (kind, _, _) in enumerate(GENERATORS)]
    return rows.withColumn("found", F.flatten(F.array(*gens)))


def _listed(i: int, kind: str) -> Column:
    def describe(x):
        before = F.substring("text", F.greatest(x["s"] - AROUND + 1, F.lit(1)), F.least(F.lit(AROUND), x["s"]))
        n = F.length(digits(x["m"]))
        context = {"assigned": before.rlike(ASSIGNED), "contact": before.rlike(CONTACT), "version": before.rlike(VERSION)}
        fields = [
            x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind"), F.lit(i).alias("gen"),
            F.when(n < 10, 0).when(n < 13, 1).when(n < 16, 2).when(n == 16, 3).otherwise(4).alias("digits"),
            _char_class(F.substring("text", x["s"], F.when(x["s"] > 0, 1).otherwise(0))).alias("before"),
            _char_class(F.substring("text", x["e"] + 1, F.lit(1))).alias("after"),
            before.rlike(ASSIGNED if kind == "secret" else SECRET).cast("int").alias("secret"),
            context["contact"].cast("int").alias("contact"), context["version"].cast("int").alias("version"),
            x["m"].rlike("[ ()-]").cast("int").alias("parted"), _signed(kind, x["m"]).cast("int").alias("signed"),
            plausible(i, kind, x["m"], context).cast("int").alias("good"),
        ]
        overlaps = F.exists(f"base_{kind}", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])) if kind in BASE_KINDS else F.lit(False)
        return F.struct(*fields, overlaps.alias("covered"))

    return F.transform(f"g{i}", describe)


def _signed(kind: str, found: Column) -> Column:
    """Whether a candidate carries its kind's own sign: bracketed words, Luhn's sum, parts up to 255, a country, digits among letters."""
    return {
        "email": found.rlike(r"[(\[]"), "card": luhn(found), "ip": found.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        "phone": found.startswith("+"), "secret": found.rlike("[0-9]") & found.rlike("[A-Za-z]"),
    }[kind]


def found_in(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``text`` (null: empty), the base spans of each kind and all candidates."""
    rows = docs.withColumn("text", F.coalesce(F.col(text), F.lit("")))
    rows = matches(rows, [(f"raw_{k}", HINT[k], BASE[k]) for k in BASE_KINDS])
    for kind in BASE_KINDS:
        rows = rows.withColumn(f"base_{kind}", F.filter(f"raw_{kind}", _passing(kind))).drop(f"raw_{kind}")
    rows = matches(rows, [(f"g{i}", hint, pattern) for i, (_, hint, pattern) in enumerate(GENERATORS)])
    return candidates(rows).drop(*(f"g{i}" for i in range(len(GENERATORS))))


def _passing(kind: str):
    return lambda x: passes(kind, x["m"])


@dataclass
class Trees:
    """Boosted trees of two levels over the features, and each generator's threshold."""

    trees: list[tuple]
    prior: float
    thresholds: list[float]

    def raw(self, x: dict) -> float:
        return self.prior + sum(value(tree, x) for tree in self.trees)

    def column(self, of) -> Column:
        """The trees as one expression; ``of`` gives the column of a feature."""
        sums = [_case(tree, of) for tree in self.trees]
        raw = reduce(lambda a, b: a + b, sums, F.lit(self.prior))
        return 1 / (1 + F.exp(-raw))


def value(tree, x) -> float:
    while isinstance(tree, tuple):
        feature, level, yes, no = tree
        tree = yes if x[feature] == level else no
    return tree


def _case(tree, of) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    feature, level, yes, no = tree
    return F.when(of(feature) == level, _case(yes, of)).otherwise(_case(no, of))


def _grow(cells: list[tuple[dict, float, float, float]], depth: int):
    """A tree on (features, residual, curvature, rows): the split with the largest gain, a Newton step in each leaf."""
    g, h = sum(c[1] for c in cells), sum(c[2] for c in cells)
    leaf = RATE * g / (h + 1.0)
    if not depth:
        return leaf
    best = None
    for feature, levels in FEATURES.items():
        sums = {}
        for x, r, k, _ in cells:
            a = sums.setdefault(x[feature], [0.0, 0.0])
            a[0] += r
            a[1] += k
        for level in sorted(sums):
            a, b = sums[level]
            gain = a * a / (b + 1.0) + (g - a) ** 2 / (h - b + 1.0) - g * g / (h + 1.0)
            if len(sums) > 1 and (best is None or gain > best[0] + 1e-9):
                best = (gain, feature, level)
    if best is None or best[0] < 1e-6:
        return leaf
    _, feature, level = best
    inside = [c for c in cells if c[0][feature] == level]
    outside = [c for c in cells if c[0][feature] != level]
    return feature, level, _grow(inside, depth - 1), _grow(outside, depth - 1)


def boost(
    cells: list[tuple[dict, int, int]], held: list[tuple[dict, int, int]] | None = None, precision: float = PRECISION, trees: int = TREES
) -> Trees:
    """Gradient boosting on (features, rows, rows that are plausible), and thresholds calibrated on the counts of ``held``
    (by default the same).

    A generator's threshold is the lowest score from which on at least ``precision`` of its candidates are
    plausible, and never under ``FLOOR``; a generator without such a score adds nothing.
    """
    total, good = sum(n for _, n, _ in cells), sum(k for _, _, k in cells)
    share = (good + 0.5) / (total + 1.0)
    model = Trees([], math.log(share / (1 - share)), [2.0] * len(GENERATORS))
    raw = [model.prior] * len(cells)
    for _ in range(trees if total else 0):
        p = [1 / (1 + math.exp(-r)) for r in raw]
        tree = _grow([(x, k - n * q, n * q * (1 - q), n) for (x, n, k), q in zip(cells, p)], 3)
        model.trees.append(tree)
        raw = [r + value(tree, x) for r, (x, _, _) in zip(raw, cells)]
    checked = cells if held is None else held
    for gen in range(len(GENERATORS)):
        own = sorted(((model.raw(x), n, k) for x, n, k in checked if x["gen"] == gen), reverse=True)
        n = k = 0
        for i, (r, a, b) in enumerate(own):
            n, k = n + a, k + b
            if k and k >= precision * n and (i + 1 == len(own) or own[i + 1][0] < r):
                model.thresholds[gen] = max(FLOOR, 1 / (1 + math.exp(-r)) - 1e-9)
    return model


def fit(rows: DataFrame) -> Trees:
    """Trees fitted on the candidates of three quarters of the documents and thresholds on the others' (by a hash of the text):
    counted by features, so at most twice the grid's size comes back."""
    apart = (F.pmod(F.xxhash64("text"), F.lit(HELD)) == 0).alias("held")
    each = rows.select(apart, F.explode("found").alias("x"))
    cells = each.groupBy("held", *(F.col(f"x.{f}").alias(f) for f in FEATURES)).agg(F.count("*").alias("n"), F.sum("x.good").alias("k"))
    listed = sorted((({f: r[f] for f in FEATURES}, r["n"], r["k"], r["held"]) for r in cells.collect()), key=lambda c: [c[0][f] for f in FEATURES])
    return boost([c[:3] for c in listed if not c[3]], [c[:3] for c in listed if c[3]])


def detect(docs: DataFrame, text: str = "text", model: Trees | None = None) -> DataFrame:
    """``docs`` (their columns boxed in ``row``) with ``text``, ``base`` and ``spans``: arrays of (kind, s, e), by kind, then place.

    ``spans`` has the base spans and the candidates that the trees accept; a candidate that overlaps a base
    span of its kind, or lies inside another accepted one of its kind, adds nothing. Places are code points,
    the end is exclusive. A null text is empty; whole texts of any length; no document meets another but in
    the counts that the trees are fitted on; repeated rows come back as often.
    """
    boxed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(text).alias("text"))
    rows = found_in(boxed, "text")
    model = model or fit(rows)
    limit = F.array(*map(F.lit, model.thresholds))
    scored = F.transform(
        F.filter("found", lambda x: ~x["covered"]),
        lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), (model.column(lambda f: x[f]) >= F.element_at(limit, x["gen"] + 1)).alias("ok")),
    )
    rows = rows.withColumn("_more", F.array_distinct(F.filter(scored, lambda x: x["ok"])))
    larger = lambda x, y: (x["kind"] == y["kind"]) & (y["s"] <= x["s"]) & (x["e"] <= y["e"]) & ((y["e"] - y["s"]) > (x["e"] - x["s"]))
    added = F.filter("_more", lambda x: ~F.exists("_more", lambda y: larger(x, y)))
    rank = lambda kind, x: F.struct(F.lit(KINDS.index(kind)).alias("r"), x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind"))
    base = F.flatten(F.array(*(_ranked(kind, rank) for kind in BASE_KINDS)))
    place = F.create_map(*(x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))))
    more = F.transform(added, lambda x: F.struct(place[x["kind"]].alias("r"), x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")))
    return rows.select("row", "text", base.alias("base"), F.sort_array(F.concat(base, more)).alias("spans"))


def _ranked(kind: str, rank) -> Column:
    return F.transform(f"base_{kind}", lambda x: rank(kind, x))


def written(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, the number of base spans of each kind, ``base_sha256``, ``spans`` and their number; cases as in
    ``detect``."""
    found = detect(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(F.col("row.doc_id").alias("doc_id"), *map(count, BASE_KINDS), F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of personal data in ``text`` replaced by its kind in square brackets. Spans that overlap are
    one, under the first's kind. Columns as given; a null text stays null."""
    found = detect(docs, text)
    ordered = F.array_sort(F.transform("spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a, x):
        gap = F.substring("text", a["at"] + 1, F.greatest(x["s"] - a["at"], F.lit(0)))
        more = F.concat(a["out"], gap, F.lit("["), x["kind"], F.lit("]"))
        return F.struct(F.greatest(a["at"], x["e"]).alias("at"), F.when(x["s"] >= a["at"], more).otherwise(a["out"]).alias("out"))

    clean = F.aggregate(ordered, start, step, lambda a: F.concat(a["out"], F.substring("text", a["at"] + 1, F.length("text"))))
    new = F.when(F.size("spans") > 0, clean).otherwise(F.col("row").getField(text))
    return found.withColumn("_clean", new).select(*(F.col("_clean").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns))
