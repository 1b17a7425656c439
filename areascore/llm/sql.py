"""SQL twins of the queries that SQL can express, written from the operators' rules."""

# Fixed values of the quality rules, written out so that a changed parameter shows: symbols, classes of characters, words
# of a run, common words of a language, and the limits of the two distances with the words they need.
SYMBOLS = "#*$%&|<>"
CLASSES = {
    "vowels": "aeiouAEIOU", "consonants": "bcdfghjklmnpqrstvwxyzBCDFGHJKLMNPQRSTVWXYZ", "digits": "0123456789",
    "punctuation": ".,;:!?'\"()-", "symbols": "#*$%&|<>@=+/\\_~^`{}[]",
}
RUN, COMMON = 5, 32
CHAR_LIMIT, CHAR_WORDS = 0.35, 30
WORD_LIMIT, WORD_WORDS = 0.36, 50

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH d AS (
  SELECT doc_id, source, len({WORDS.format("coalesce(text, '')")}) AS size,
         md5(concat_ws(':', 1, doc_id)) AS draw, coalesce(md5(text), '') AS digest
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM d GROUP BY source),
w AS (SELECT *, CASE place % 3 WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS weight, source_size * 2e0 AS cap FROM s),
r AS (
  SELECT *, cap / weight AS ratio, sum(source_size) OVER () * 1.5e0 AS budget, sum(weight) OVER () AS all_weight,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
         coalesce(sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_before
  FROM w),
l AS (SELECT *, (budget - cap_before) / (all_weight - weight_before) AS level FROM r),
common AS (SELECT arg_min(level, ratio) AS common FROM l WHERE cap > level * weight),
t AS (SELECT l.*, least(cap, coalesce(common * weight, cap)) AS target FROM l, common),
p AS (
  SELECT d.*, t.place, t.source_size, t.target,
         coalesce(sum(size) OVER (PARTITION BY place ORDER BY draw, doc_id, size, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2e0 AS middle
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
u AS (
  SELECT *, CASE WHEN size > 0 AND middle < target THEN middle / target END AS done,
         CASE WHEN size = 0 THEN 0 ELSE (middle < target)::INT + (middle + source_size < target)::INT END AS uses
  FROM p)
SELECT doc_id, size, source_size, target, size * uses AS taken,
  round(CASE place % 3
    WHEN 0 THEN least(done * 2 / (sqrt(1.4e0 * 1.4e0 - done * 1.6e0) + 1.4e0), 1)
    WHEN 1 THEN done
    ELSE CASE WHEN done >= 0.35e0 THEN 0.5e0 + (done - 0.35e0) * 2 / (sqrt(1 + (done - 0.35e0) * 2.4e0) + 1)
         ELSE done * 2 / (sqrt(0.4e0 * 0.4e0 + done * 2.4e0) + 0.4e0) END
  END, 9) AS position
FROM u
"""

_NIBBLE = "(instr('0123456789ABCDEF', {}) - 1)"
OP10 = f"""
WITH tab AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
h AS (SELECT doc_id, coalesce(strlen(text), 0) + 16 AS size, md5(text) AS h, string_split(hex(coalesce(text, '')), '') AS c FROM documents),
b AS (
  SELECT doc_id, size, h, list_transform(range(1, len(c), 2), lambda k: {_NIBBLE.format("c[k]")} * 16 + {_NIBBLE.format("c[k + 1]")}) AS bytes
  FROM h),
d AS (
  SELECT doc_id, size, h,
    xor(list_reduce(list_concat([4294967295], bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM b, tab),
p AS (
  SELECT *, sum(size) OVER () AS total,
    sum(size) OVER (ORDER BY h NULLS FIRST, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM d),
s AS (SELECT *, ((2 * before + size) * 40) // (2 * total) AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY before, h NULLS FIRST, doc_id NULLS FIRST) - 1 AS slot,
  NULL::INT AS grown_shard
FROM s
"""


def _quoted(characters: str) -> str:
    return "'" + characters.replace("'", "''") + "'"


_COUNTS = ", ".join(
    f"length(packed) - length(translate(packed, {_quoted(v)}, '')) AS {k}" for k, v in CLASSES.items()
)
_SUMS = ", ".join(f"sum({c}) AS {c}" for c in [*CLASSES, "upper", "word_chars"])
_SHARES = ", ".join(f"{{0}}.{c} / {{0}}.word_chars" for c in CLASSES)


def _distance(p: str, q: str) -> str:
    """Root of the Jensen-Shannon divergence of two lists of shares; what lacks to 1 is one more share."""
    def full(x):
        return f"list_append({x}, greatest(0, 1 - coalesce(list_sum({x}), 0)))"

    term = "CASE WHEN z[{0}] > 0 THEN z[{0}] * log2(z[{0}] * 2 / (z[1] + z[2])) ELSE 0 END"
    terms = f"list_transform(list_transform(list_zip({full(p)}, {full(q)}), lambda y: [y[1], y[2]]), lambda z: ({term.format(1)} + {term.format(2)}) / 2)"
    return f"sqrt(least(1, greatest(0, list_sum({terms}))))"


OP6 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text,
         {WORDS.format("coalesce(text, '')")} AS words
  FROM documents),
m AS (
  SELECT *, len(words) AS n_words, regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS packed,
    length(text) - length(translate(text, {_quoted(SYMBOLS)}, '')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
c AS (
  SELECT *, length(packed) AS word_chars, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    length(packed) - length(regexp_replace(packed, '[A-Z]', '', 'g')) AS upper, {_COUNTS}
  FROM m),
g AS (SELECT r, unnest(range(1, n_words - {RUN - 2})) AS i, words FROM c WHERE n_words >= {RUN}),
runs AS (SELECT r, i, array_to_string(words[i:i + {RUN - 1}], ' ') AS run FROM g),
rep AS (SELECT r, i FROM runs QUALIFY count(*) OVER (PARTITION BY r, run) > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM rep, range({RUN}) x(k) GROUP BY r),
every AS (SELECT coalesce(lang, '') AS lang, lang IS NULL AS pooled, * EXCLUDE (lang) FROM c WHERE lang IS NOT NULL
          UNION ALL SELECT '' AS lang, true AS pooled, * EXCLUDE (lang) FROM c),
cls AS (SELECT lang, pooled, sum(n_words) AS all_words, {_SUMS} FROM every GROUP BY ALL),
wc AS (SELECT lang, pooled, lower(w) AS w, count(*) AS n FROM (SELECT lang, pooled, unnest(words) AS w FROM every) GROUP BY ALL),
top AS (SELECT * FROM wc QUALIFY row_number() OVER (PARTITION BY lang, pooled ORDER BY n DESC, w) <= {COMMON}),
own AS (
  SELECT r, w, count(*) AS n FROM (SELECT r, lower(w) AS w FROM (SELECT r, unnest(words) AS w FROM c)) GROUP BY ALL),
hist AS (
  SELECT c.r, list(coalesce(own.n, 0) / c.n_words ORDER BY top.n DESC, top.w) AS p, list(top.n / cls.all_words ORDER BY top.n DESC, top.w) AS q
  FROM c JOIN top ON top.lang = coalesce(c.lang, '') AND top.pooled = (c.lang IS NULL)
  JOIN cls ON cls.lang = top.lang AND cls.pooled = top.pooled
  LEFT JOIN own ON own.r = c.r AND own.w = top.w
  WHERE c.n_words > 0 GROUP BY c.r),
dist AS (
  SELECT c.r, c.doc_id, n_words, c.word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    greatest({_distance("[" + _SHARES.format("c") + "]", "[" + _SHARES.format("cls") + "]")},
             {_distance("[c.upper / c.word_chars]", "[cls.upper / cls.word_chars]")}) AS char_distance,
    {_distance("hist.p", "hist.q")} AS word_distance
  FROM c LEFT JOIN cov USING (r) LEFT JOIN hist ON hist.r = c.r
  LEFT JOIN cls ON cls.lang = coalesce(c.lang, '') AND cls.pooled = (c.lang IS NULL)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM dist)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(n_words >= {CHAR_WORDS} AND char_distance > {CHAR_LIMIT}, false)
    AND NOT coalesce(n_words >= {WORD_WORDS} AND word_distance > {WORD_LIMIT}, false) AS kept
FROM b
"""

_DRAW = "('0x' || substr(h, {}, 8))::UBIGINT"
OP12 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t
  FROM documents),
n AS (SELECT *, len(t) AS n FROM d),
c AS (
  SELECT *, least({_DRAW.format(1)} % (n + 1), {_DRAW.format(9)} % (n + 1))::BIGINT AS a,
    greatest({_DRAW.format(1)} % (n + 1), {_DRAW.format(9)} % (n + 1))::BIGINT AS b,
    CASE WHEN doc_id IS NULL OR text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR {_DRAW.format(17)} % 100 >= 50 THEN 'plain' WHEN {_DRAW.format(25)} % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM n),
p AS (
  SELECT doc_id, n, form, text, array_to_string(list_slice(t, 1, a), '') AS prefix, array_to_string(list_slice(t, a + 1, b), '') AS middle,
    array_to_string(list_slice(t, b + 1, n), '') AS suffix
  FROM c)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
OP13 = f"""
WITH dt AS (SELECT r, doc_id, unnest({_TERMS}) AS term FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM dt GROUP BY ALL),
l AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
s AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM l),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY term, nd),
it AS (SELECT i, item_id, unnest({_TERMS}) AS term FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)),
q AS (SELECT i, item_id, term, count(*) AS q FROM it GROUP BY ALL),
f AS (
  SELECT i, item_id, tf.r, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nd) // nt))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN l ON l.r = tf.r, s GROUP BY i, item_id, tf.r, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM f WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= 20
"""

ORACLES = {"op1_mixing": OP1, "op6_quality": OP6, "op10_sharding": OP10, "op12_middle": OP12, "op13_search": OP13}
