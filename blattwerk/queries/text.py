"""Queries on text: plain text, words, citations, outline, vocabulary, accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blattwerk.functions import text as T
from blattwerk.operators import accuracy, boilerplate, outline, vocabulary
from blattwerk.queries.lines import BOXED
from blattwerk.queries.quality import BLOCKS, LINES
from blattwerk.queries.registry import register
from blattwerk.sources.pages import blocks, boxed, lines_of
from blattwerk.sources.tables import table

CITATION = "(?:§{1,2}|Art\\.)[\\t\\n\\f\\r\\v ]*[0-9]+[a-z]?"
WORD = "[\\p{L}\\p{N}_§€%]+"
PLAIN = (
    "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '(?s)%%.*?%%', ' ', 'g'),"
    " '!\\[\\[.*?\\]\\]', ' ', 'g'), '(?m)^[\\t\\n\\f\\r\\v ]*>[\\t\\n\\f\\r\\v ]?', '', 'g'), '(?m)^#{{1,6}}[\\t\\n\\f\\r\\v ]*', '', 'g'),"
    " '\\[\\^([0-9]+)\\]:?', ' \\1 ', 'g'), '\\*\\*|\\|', ' ', 'g'), '[\\t\\n\\f\\r\\v ]+', ' ', 'g'))"
)

register(
    "plain_text",
    lambda s, d: blocks(s, d).where("markdown IS NOT NULL").select("block_id", T.plain_text(F.col("markdown")).alias("plain")),
    f"WITH {BLOCKS} SELECT block_id, {PLAIN.format('markdown')} AS plain FROM blocks WHERE markdown IS NOT NULL",
)
register(
    "seam_keys",
    lambda s, d: lines_of(blocks(s, d)).select("block_id", "seq", T.seam_key(F.col("text")).alias("key"), T.blind_digits(F.col("text")).alias("blind")),
    f"WITH {LINES} SELECT block_id, CAST(seq AS INT) AS seq, regexp_replace(lower(text), '[^0-9a-zäöüß]+', '', 'g') AS key, regexp_replace(text, '[0-9]+', '#', 'g') AS blind FROM lines",
)
register(
    "clean_cells",
    lambda s, d: blocks(s, d).where(F.col("markdown").contains("|")).select("block_id", T.clean_cell(F.col("markdown")).alias("cell")),
    f"""WITH {BLOCKS} SELECT block_id, regexp_replace(replace(regexp_replace(regexp_replace(trim(markdown), '([a-zäöüß])-[\\t\\n\\f\\r\\v ]*\\n[\\t\\n\\f\\r\\v ]*([a-zäöüß])', '\\1\\2', 'g'),
  '[\\t\\n\\f\\r\\v ]*\\n[\\t\\n\\f\\r\\v ]*', ' ', 'g'), '|', '\\|'), '[\\t\\n\\f\\r\\v ]+', ' ', 'g') AS cell FROM blocks WHERE contains(markdown, '|')""",
)
register(
    "bold_lines",
    lambda s, d: lines_of(blocks(s, d)).where(F.col("text").contains("**")).select("block_id", "seq", T.balance_bold(F.col("text")).alias("balanced"), T.without_bold(F.col("text")).alias("bare"), T.only_bold(F.col("text")).alias("only")),
    f"""WITH {LINES}, b AS (SELECT *, (length(text) - length(replace(text, '**', ''))) // 2 AS n, length(text) - strpos(reverse(text), '**') AS place FROM lines WHERE contains(text, '**'))
SELECT block_id, CAST(seq AS INT) AS seq, CASE WHEN n % 2 = 1 THEN substr(text, 1, place - 1) || substr(text, place + 2) ELSE text END AS balanced, trim(replace(text, '**', '')) AS bare,
  trim(text) <> '' AND trim(regexp_replace(text, '(?s)\\*\\*.*?\\*\\*', '', 'g')) = '' AS "only" FROM b""",
)
register(
    "word_frequency",
    lambda s, d: blocks(s, d).select(F.explode(T.word_list(F.col("markdown"))).alias("word")).where(vocabulary.checkable(F.col("word"))).groupBy("word").count(),
    f"""WITH {BLOCKS}, w AS (SELECT unnest(regexp_extract_all(markdown, '{WORD}')) AS word FROM blocks)
SELECT word, count(*) AS count FROM w WHERE length(word) >= 4 AND NOT ((regexp_matches(word, '\\p{{L}}') AND NOT regexp_matches(word, '\\p{{Ll}}')) OR regexp_matches(substr(word, 2), '\\p{{Lu}}')) GROUP BY word""",
)


def _words(s: SparkSession, d: str) -> DataFrame:
    w = blocks(s, d).where(F.col("origin") == "ocr").select(F.explode(F.regexp_extract_all("markdown", F.lit(r"(\p{L}+)"), F.lit(1))).alias("word"))
    return w.where(vocabulary.checkable(F.col("word"))).groupBy("word").count()


_OCR_WORDS = f"""{BLOCKS}, ocr AS (SELECT word, count(*) AS count FROM (SELECT unnest(regexp_extract_all(markdown, '\\p{{L}}+')) AS word FROM blocks WHERE origin = 'ocr')
  WHERE length(word) >= 4 AND NOT (NOT regexp_matches(word, '\\p{{Ll}}') OR regexp_matches(substr(word, 2), '\\p{{Lu}}')) GROUP BY word),
v AS (SELECT DISTINCT lower(word) AS low FROM vocab), u AS (SELECT * FROM ocr WHERE lower(word) NOT IN (SELECT low FROM v WHERE low IS NOT NULL))"""
register("unknown_words", lambda s, d: vocabulary.unknown(_words(s, d), table(s, d, "vocab")), f"WITH {_OCR_WORDS} SELECT word, count FROM u")
_PAIRS = ", ".join(f"('{a}', '{b}'), ('{b}', '{a}')" for a, b in vocabulary.CONFUSIONS)
_CANDIDATES = f"""pairs(src, dst) AS (VALUES {_PAIRS}),
b AS (SELECT word, regexp_matches(word, '^\\p{{Lu}}') AS cap, CASE WHEN regexp_matches(word, '^\\p{{Lu}}') THEN lower(substr(word, 1, 1)) || substr(word, 2) ELSE word END AS base FROM u),
c AS (SELECT DISTINCT word, CASE WHEN cap THEN CASE WHEN made LIKE 'ß%' THEN 'SS' ELSE upper(substr(made, 1, 1)) END || substr(made, 2) ELSE made END AS candidate FROM (
  SELECT word, cap, substr(base, 1, i - 1) || dst || substr(base, i + length(src)) AS made
  FROM b JOIN pairs ON contains(base, src), LATERAL (SELECT unnest(range(1, length(base) + 1)) AS i) WHERE substr(base, i, length(src)) = src))"""
register("confusions", lambda s, d: vocabulary.candidates(vocabulary.unknown(_words(s, d), table(s, d, "vocab"))), f"WITH {_OCR_WORDS}, {_CANDIDATES} SELECT word, candidate FROM c WHERE candidate <> word")
register(
    "unique_correction",
    lambda s, d: vocabulary.corrections(_words(s, d), table(s, d, "vocab")),
    f"""WITH {_OCR_WORDS}, {_CANDIDATES}, k AS (SELECT word, count(*) AS k, min(candidate) AS suggestion FROM c WHERE candidate <> word AND lower(candidate) IN (SELECT low FROM v WHERE low IS NOT NULL) GROUP BY word)
SELECT word, count, suggestion FROM u LEFT JOIN (SELECT * FROM k WHERE k = 1) USING (word)""",
)
_V = vocabulary
# Words taken apart into segments, the segments reduced to forms of the vocabulary, heads followed from place to place.
_KNOWN = f"""v0 AS (SELECT DISTINCT lower(word) AS low FROM vocab WHERE word IS NOT NULL),
endings(e) AS (VALUES {", ".join(f"('{e}')" for e in sorted(set(_V.ENDINGS)))}), suffixes(x) AS (VALUES {", ".join(f"('{x}')" for x in _V.STEM_SUFFIXES)}), joints(j) AS (VALUES {", ".join(f"('{j}')" for j in _V.JOINTS)}),
forms AS (SELECT DISTINCT word, lower(word) AS w, true AS own FROM asked UNION SELECT DISTINCT word, substr(lower(word), 3), false FROM asked WHERE lower(word) LIKE 'un%' AND length(word) >= 6),
items AS (SELECT DISTINCT w, length(w) AS n FROM forms),
segs AS (SELECT DISTINCT w, n, a, b, substr(w, a + 1, b - a) AS part FROM (SELECT w, n, unnest(range(0, greatest(n - 2, 1))) AS a FROM items) i, LATERAL (SELECT unnest(range(least(a + 3, n), n + 1)) AS b) WHERE a = 0 OR a >= 4),
parts AS (SELECT DISTINCT part FROM segs),
s1 AS (SELECT part, substr(part, 1, length(part) - length(e)) AS stem FROM parts, endings WHERE ends_with(part, e) AND length(part) - length(e) >= 3),
s2 AS (SELECT part, substr(stem, 1, length(stem) - length(e)) AS stem FROM s1, endings WHERE ends_with(stem, e) AND length(stem) - length(e) >= 3),
good AS (SELECT part FROM parts JOIN v0 ON part = low UNION SELECT part FROM (SELECT part, stem || x AS base FROM (SELECT * FROM s1 UNION SELECT * FROM s2), suffixes) JOIN v0 ON base = low),
hits AS (SELECT w, n, a, b FROM segs JOIN good USING (part)),
edges AS (SELECT DISTINCT w, n, a, b + length(j) AS t FROM hits, joints WHERE b - a >= 4 AND substr(w, b + 1, length(j)) = j AND b + length(j) <= n - 3),
r1 AS (SELECT w, t FROM edges WHERE a = 0), r2 AS (SELECT DISTINCT e.w, e.t FROM r1 JOIN edges e ON e.w = r1.w AND e.a = r1.t), r3 AS (SELECT DISTINCT e.w, e.t FROM r2 JOIN edges e ON e.w = r2.w AND e.a = r2.t),
ok AS (SELECT DISTINCT w FROM hits WHERE a = 0 AND b = n UNION SELECT h.w FROM hits h JOIN (SELECT * FROM r1 UNION SELECT * FROM r2 UNION SELECT * FROM r3) r ON h.w = r.w AND h.a = r.t AND h.b = h.n),
judged AS (SELECT word, bool_or(w IN (SELECT w FROM ok)) AS known, bool_or(own AND w IN (SELECT w FROM hits WHERE a = 0 AND b = n)) AS direct FROM forms GROUP BY word)"""
register("known_forms", lambda s, d: vocabulary.known_forms(_words(s, d), table(s, d, "vocab")), f"WITH {_OCR_WORDS}, asked AS (SELECT word FROM ocr), {_KNOWN} SELECT word, known, direct FROM judged")


def _checked(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return vocabulary.checked_text(blocks(s, d).where(F.col("origin") == "ocr").select("block_id", "markdown"), "block_id", "markdown", table(s, d, "vocab"))


register("dictionary_findings", lambda s, d: _checked(s, d)[0])
register("dictionary_text", lambda s, d: _checked(s, d)[1].select("block_id", F.md5("markdown").alias("text_md5")))
register("ranked_findings", lambda s, d: vocabulary.ranked(vocabulary.unknown(_words(s, d), table(s, d, "vocab"))), f"WITH {_OCR_WORDS}, r AS (SELECT word, count, row_number() OVER (ORDER BY count DESC, word) AS rank FROM u) SELECT * FROM r WHERE rank <= 12")


def _pairs(s: SparkSession, d: str) -> DataFrame:
    """True text against a reading of it with two glyphs confused."""
    b = blocks(s, d).where("markdown IS NOT NULL").select("block_id", "origin", T.plain_text(F.col("markdown")).alias("t"))
    return b.select("block_id", "origin", "t", F.translate("t", "q7ß", "g1s").alias("r"))


_READ = f"{BLOCKS}, p AS (SELECT block_id, origin, {PLAIN.format('markdown')} AS t FROM blocks WHERE markdown IS NOT NULL), q AS (SELECT *, translate(t, 'q7ß', 'g1s') AS r FROM p)"
_COMMON = """x AS (SELECT block_id, w, sum(a) AS a, sum(b) AS b FROM (SELECT block_id, unnest(regexp_extract_all(t, '{0}')) AS w, 1 AS a, 0 AS b FROM q
  UNION ALL SELECT block_id, unnest(regexp_extract_all(r, '{0}')), 0, 1 FROM q) GROUP BY ALL),
n AS (SELECT block_id, CAST(sum(a) AS BIGINT) AS true_n, CAST(sum(b) AS BIGINT) AS read_n, CAST(sum(least(a, b)) AS BIGINT) AS common FROM x GROUP BY block_id)"""
register(
    "multiset_overlap",
    lambda s, d: accuracy.overlap(_pairs(s, d), "block_id", T.word_list(F.col("t")), T.word_list(F.col("r"))),
    f"WITH {_READ}, {_COMMON.format(WORD)} SELECT block_id, coalesce(true_n, 0) AS true_n, coalesce(read_n, 0) AS read_n, coalesce(common, 0) AS common FROM q LEFT JOIN n USING (block_id)",
)


def _accuracy(s: SparkSession, d: str) -> DataFrame:
    o = accuracy.overlap(_pairs(s, d), "block_id", T.word_list(F.col("t")), T.word_list(F.col("r")))
    return o.join(_pairs(s, d).select("block_id", F.coalesce("origin", F.lit("none")).alias("cohort")), "block_id").where("true_n > 0").withColumn("share", F.col("common") / F.col("true_n"))


_SHARES = f"{_READ}, {_COMMON.format(WORD)}, a AS (SELECT block_id, coalesce(origin, 'none') AS cohort, true_n, common / true_n AS share FROM q JOIN n USING (block_id) WHERE true_n > 0)"
register(
    "micro_average",
    lambda s, d: _accuracy(s, d).agg(F.round(accuracy.weighted_mean(F.col("share"), F.col("true_n")), 9).alias("word_accuracy"), F.count(F.lit(1)).alias("pages")),
    f"WITH {_SHARES} SELECT round(sum(share * true_n) / sum(true_n), 9) AS word_accuracy, count(*) AS pages FROM a",
)
register(
    "upper_median",
    lambda s, d: _accuracy(s, d).transform(lambda a: accuracy.upper_medians(a, "cohort", "true_n")),
    f"WITH {_SHARES} SELECT cohort, list_sort(list(true_n))[count(*) // 2 + 1] AS middle, min(true_n) AS least, max(true_n) AS most FROM a GROUP BY cohort",
)
register(
    "cohort_rollup",
    lambda s, d: _accuracy(s, d).rollup("cohort").agg(F.round(accuracy.weighted_mean(F.col("share"), F.col("true_n")), 9).alias("word_accuracy"), F.count(F.lit(1)).alias("pages")),
    f"WITH {_SHARES} SELECT cohort, round(sum(share * true_n) / sum(true_n), 9) AS word_accuracy, count(*) AS pages FROM a GROUP BY ROLLUP (cohort)",
)
register(
    "missing_top12",
    lambda s, d: accuracy.missing(_pairs(s, d), "block_id", T.citations(F.col("t")), T.citations(F.col("r"))).groupBy("item").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "item").limit(12),
    f"""WITH {_READ}, x AS (SELECT block_id, item, sum(d) AS n FROM (SELECT block_id, unnest(regexp_extract_all(t, '{CITATION}')) AS item, 1 AS d FROM q
  UNION ALL SELECT block_id, unnest(regexp_extract_all(r, '{CITATION}')), -1 FROM q) GROUP BY ALL HAVING sum(d) > 0)
SELECT item, CAST(sum(n) AS BIGINT) AS n FROM x GROUP BY item ORDER BY n DESC, item LIMIT 12""",
)
register(
    "citation_report",
    lambda s, d: accuracy.overlap(_pairs(s, d), "block_id", T.citations(F.col("t")), T.citations(F.col("r"))).where("true_n > 0").withColumn("weak", F.col("common") < 0.9 * F.col("true_n")),
    f"WITH {_READ}, {_COMMON.format(CITATION)} SELECT block_id, true_n, read_n, common, common < 0.9 * true_n AS weak FROM n WHERE true_n > 0",
)
register(
    "order_similarity",
    lambda s, d: accuracy.order_similarity(_pairs(s, d).select("block_id", T.word_list(F.col("t")).alias("t"), T.word_list(F.col("r")).alias("r")), "block_id", "t", "r"),
)


def _bag(s: SparkSession, d: str, origin: str) -> DataFrame:
    return lines_of(blocks(s, d).where(F.col("origin") == origin)).select(T.squeeze(T.blind_digits(F.col("text"))).alias("line"))


_BAG = "SELECT trim(regexp_replace(regexp_replace(text, '[0-9]+', '#', 'g'), '[\\t\\n\\f\\r\\v ]+', ' ', 'g')) AS line FROM lines WHERE origin = '{}'"
register("bag_intersection", lambda s, d: _bag(s, d, "ocr").intersectAll(_bag(s, d, "textlayer")), f"WITH {LINES} ({_BAG.format('ocr')}) INTERSECT ALL ({_BAG.format('textlayer')})")
register("bag_difference", lambda s, d: _bag(s, d, "ocr").exceptAll(_bag(s, d, "textlayer")), f"WITH {LINES} ({_BAG.format('ocr')}) EXCEPT ALL ({_BAG.format('textlayer')})")
register("set_union", lambda s, d: _bag(s, d, "ocr").union(_bag(s, d, "textlayer")).distinct(), f"WITH {LINES} ({_BAG.format('ocr')}) UNION ({_BAG.format('textlayer')})")
register(
    "char_multiset",
    lambda s, d: blocks(s, d).select("origin", F.explode(F.split(F.regexp_replace(F.coalesce("markdown", F.lit("")), r"[*#>|\s]+", ""), "")).alias("c")).where("c <> ''").groupBy("origin", "c").count(),
    f"WITH {BLOCKS}, c AS (SELECT origin, unnest(string_split(regexp_replace(coalesce(markdown, ''), '[*#>|\\t\\n\\f\\r\\v ]+', '', 'g'), '')) AS c FROM blocks) SELECT origin, c, count(*) AS count FROM c WHERE c <> '' GROUP BY ALL",
)
register(
    "outline_levels",
    lambda s, d: lines_of(blocks(s, d)).select("block_id", "seq", outline.level(F.col("text")).alias("level")).where("level IS NOT NULL"),
    f"""WITH {LINES}, b AS (SELECT block_id, seq, regexp_replace(regexp_replace(text, '\\*+', '', 'g'), '^[\\t\\n\\f\\r\\v ]+', '') AS t FROM lines),
m AS (SELECT *, CASE WHEN regexp_matches(t, '^\\((?:[0-9]{{1,2}}|[a-h]{{1,2}})\\)[\\t ]') THEN 6 WHEN regexp_matches(t, '^(?:(?:aa|bb|cc|dd|ee|gg|hh)[.)]|ff\\))[\\t ]') THEN 6
  WHEN regexp_matches(t, '^(?:[a-eg-h][.)]|f\\))[\\t ]') THEN 5 WHEN regexp_matches(t, '^[0-9]{{1,2}}[.)][\\t ]') THEN 4 WHEN regexp_matches(t, '^[IVX]{{1,5}}\\.[\\t ]') THEN 3
  WHEN regexp_matches(t, '^[A-H][.)][\\t ]') THEN 2 END AS level FROM b)
SELECT block_id, CAST(seq AS INT) AS seq, level FROM m WHERE level IS NOT NULL AND NOT regexp_matches(regexp_replace(t, '^\\S+[\\t ]+', ''), '^[A-Za-zÄÖÜ]{{1,2}}\\.')""",
)
_SP = "[\\t\\n\\f\\r\\v ]"
_BARE = f"regexp_replace(regexp_replace({{}}, '\\*+', '', 'g'), '^{_SP}+', '')"
_LEVELS = f"""CASE WHEN regexp_matches({{0}}, '^\\((?:[0-9]{{{{1,2}}}}|[a-h]{{{{1,2}}}})\\){_SP}') THEN 6 WHEN regexp_matches({{0}}, '^(?:(?:aa|bb|cc|dd|ee|gg|hh)[.)]|ff\\)){_SP}') THEN 6
  WHEN regexp_matches({{0}}, '^(?:[a-eg-h][.)]|f\\)){_SP}') THEN 5 WHEN regexp_matches({{0}}, '^[0-9]{{{{1,2}}}}[.)]{_SP}') THEN 4 WHEN regexp_matches({{0}}, '^[IVX]{{{{1,5}}}}\\.{_SP}') THEN 3 WHEN regexp_matches({{0}}, '^[A-H][.)]{_SP}') THEN 2 END"""
_ONE = "(starts_with(text, '**') AND ends_with(text, '**') AND length(text) - length(replace(text, '**', '')) = 4)"
_LABEL = f"regexp_matches(trim(text), '(?i)^\\**{_SP}*(?:{outline.LABELS}){_SP}*:?{_SP}*\\**$')"
_SHORT = f"(length(regexp_replace(text, '^\\*+{_SP}*', '')) <= {outline.LONGEST_HEADING})"
_ITEM = f"regexp_matches({_BARE.format('text')}, '^{_SP}*(?:[-•·▪○●⇒⇨→➢✔]|\\(?[0-9]{{1,2}}[.)]|[a-z]{{1,3}}[.)]|[IVXL]{{1,5}}\\.)(?:{_SP}|$)')"
register(
    "headings",
    lambda s, d: lines_of(blocks(s, d)).where(outline.level(F.col("text")).isNotNull()).select("block_id", "seq", outline.format_heading(F.col("text")).alias("formatted"), outline.heading(F.col("text")).alias("heading")),
    f"""WITH {LINES}, a AS (SELECT block_id, seq, text, {_BARE.format('text')} AS bare, regexp_replace(text, '^{_SP}+', '') AS raw FROM lines),
b AS (SELECT *, {_LEVELS.format('bare')} AS lvl, trim(replace(raw, '**', '')) AS blank FROM a),
c AS (SELECT *, length(blank) <= {outline.LONGEST_HEADING} OR (trim(raw) <> '' AND trim(regexp_replace(raw, '(?s)\\*\\*.*?\\*\\*', '', 'g')) = '') AS short, NOT regexp_matches(blank, '[.!?]["“»)\\]]?$') OR contains(raw, '**') AS open,
  regexp_extract(raw, '^([^\\t\\n\\f\\r\\v ]+)', 1) AS mark FROM b WHERE lvl IS NOT NULL AND NOT regexp_matches(regexp_replace(bare, '^[^\\t\\n\\f\\r\\v ]+{_SP}+', ''), '^[A-Za-zÄÖÜ]{{1,2}}\\.'))
SELECT block_id, CAST(seq AS INT) AS seq, CASE WHEN regexp_matches(raw, '^[|>\\[]') THEN text WHEN short AND open THEN repeat('#', CAST(lvl AS INT)) || ' ' || blank
  WHEN NOT starts_with(raw, '**') AND NOT regexp_matches(mark, '^[0-9]') THEN '**' || mark || '** ' || regexp_replace(raw, '^[^\\t\\n\\f\\r\\v ]+{_SP}*', '') ELSE text END AS formatted, {_ONE} AND {_SHORT} AND NOT {_LABEL} AS heading FROM c""",
)
register(
    "labels",
    lambda s, d: lines_of(blocks(s, d)).where(outline.enumeration(F.col("text")) | outline.keyword(F.col("text")) | outline.margin_label(F.col("text"))).select("block_id", "seq", outline.enumeration(F.col("text")).alias("item"), outline.line_start(F.col("text")).alias("start")),
    f"""WITH {LINES}, a AS (SELECT *, {_ITEM} AS item, regexp_matches({_BARE.format('text')}, '(?i)^(?:{outline.LABELS}){_SP}*:') AS keyword, {_LABEL} AS label FROM lines)
SELECT block_id, CAST(seq AS INT) AS seq, item, item OR ({_ONE} AND {_SHORT}) AS start FROM a WHERE item OR keyword OR label""",
)


def clean_sql() -> str:
    """The steps of a cleaned line; what Java looks ahead for is taken along and put back."""
    c = "translate(text, '" + "".join(T.PRIVATE_GLYPHS) + "', '" + "".join(T.PRIVATE_GLYPHS.values()) + "')"
    c = f"regexp_replace({c}, '[\ue000-\uf8ff]', '▪', 'g')"
    steps = [(rf"\$?\\{name}\$?([^A-Za-z]|$)", rf"{arrow}\1") for name, arrow in T.ARROWS.items()]
    steps += [
        (r"\\\(\\underline\{\\text\{(.*?)\}\}\\\)", r"\1"), (r"\\underline\{(.*?)\}", r"\1"), (r"\\text\{(.*?)\}", r"\1"), (r"\\\(|\\\)", ""), (r"\^\{([0-9]{1,2})\}", r"[^\1]"),
        (rf"\${_SP}*([0-9])", r"§ \1"), (rf"§{_SP}*§{_SP}*", "§§ "), (rf"§{_SP}+([0-9])", r"§ \1"), (rf"(§+{_SP}*[0-9]+[a-z]?{_SP}*)\|", r"\1I"), (rf"\|{_SP}+((?:{T.STATUTES})\b)", r"I \1"),
        (rf"\*\*({_SP}*)\*\*", r"\1"), (rf"{_SP}+$", ""),
    ]
    for pattern, by in steps:
        c = f"regexp_replace({c}, '{pattern}', '{by}', 'g')"
    return c


register("clean_lines", lambda s, d: lines_of(blocks(s, d)).select("block_id", "seq", T.clean_line(F.col("text")).alias("clean")), f"WITH {LINES} SELECT block_id, CAST(seq AS INT) AS seq, {clean_sql()} AS clean FROM lines")
_RE2 = lambda patterns: "(?:" + "|".join(p if p.startswith("(?i)") is False else f"(?i:{p[4:]})" for p in patterns).replace(r"\s", _SP).replace(r"\d", "[0-9]") + ")"
register(
    "boilerplate_lines",
    lambda s, d: boxed(lines_of(blocks(s, d))).where(boilerplate.boilerplate(F.col("text"), F.col("y0"))).select("block_id", "seq", "text"),
    f"""WITH {BOXED}, t AS (SELECT *, trim(regexp_replace(trim(text), '^\\*+|\\*+$', '', 'g')) AS t FROM boxed),
p AS (SELECT *, len(list_filter([{", ".join(f"'{x}'" for x in boilerplate.PLACES)}], lambda x: contains(t, x) AND contains(t, '-'))) AS places, regexp_matches(t, '{_RE2(boilerplate.WEAK)}') AS weak, y0 <= {boilerplate.HEAD} OR y0 >= {boilerplate.FOOT} AS zone FROM t)
SELECT block_id, seq, text FROM p WHERE t <> '' AND (regexp_matches(t, '{_RE2(boilerplate.HARD)}') OR (len(regexp_extract_all(t, ' - ')) >= 2 AND places >= 2)
  OR regexp_matches(t, '^(?:{"|".join(boilerplate.PLACES)}){_SP}*[-–]{_SP}*(?:[A-ZÄÖÜ][A-Za-zäöüß]{{0,12}}\\.?)?$') OR (length(t) <= {boilerplate.SHORT} AND weak)
  OR ((y0 <= {boilerplate.NUMBER_HEAD} OR y0 >= {boilerplate.NUMBER_FOOT}) AND regexp_matches(t, '^[0-9]{{1,4}}$')) OR (zone AND (weak OR (length(t) <= {boilerplate.SHORT_PLACE} AND places >= 1 AND contains(t, '-')))))""",
)
register(
    "callouts",
    lambda s, d: blocks(s, d).where(F.col("origin").isin("diagram", "diagramm")).select("block_id", T.callout(F.coalesce("markdown", F.lit("")), F.col("name")).alias("note")),
    f"""WITH {BLOCKS} SELECT block_id, '> [!note]- ' || name || chr(10) || regexp_replace(array_to_string(list_transform(string_split(coalesce(markdown, ''), chr(10)), lambda x: '> ' || x), chr(10)), '[\n> ]+$', '') AS note FROM blocks WHERE origin IN ('diagram', 'diagramm')""",
)
register(
    "natural_order",
    lambda s, d: table(s, d, "preview").select("name", T.natural_key(F.col("name")).alias("key")),
    "SELECT name, array_to_string(list_transform(regexp_extract_all(name, '[0-9]+|[^0-9]+'), lambda p: CASE WHEN regexp_matches(p, '^[0-9]+$') THEN lpad(p, 10, '0') ELSE lower(p) END), '') AS key FROM preview",
)
register(
    "readable_sizes",
    lambda s, d: blocks(s, d).groupBy("source_pdf").agg(F.sum(F.octet_length(F.coalesce("markdown", F.lit("")))).alias("n")).select("source_pdf", T.human_size(F.col("n")).alias("size")),
    f"""WITH {BLOCKS}, g AS (SELECT source_pdf, sum(strlen(coalesce(markdown, ''))) AS n FROM blocks GROUP BY source_pdf)
SELECT source_pdf, CASE WHEN n < 1024 THEN printf('%d B', CAST(n AS BIGINT)) WHEN n < 1048576 THEN printf('%.1f KB', n / 1024) WHEN n < 1073741824 THEN printf('%.1f MB', n / 1048576) ELSE printf('%.1f GB', n / 1073741824) END AS size FROM g""",
)
register(
    "image_names",
    lambda s, d: blocks(s, d).where(F.col("origin").isin("diagram", "diagramm")).select("block_id", F.concat(F.replace("name", F.lit(" "), F.lit("-")), F.lit("-s"), F.lpad(F.col("page_no").cast("string"), 3, "0"), F.lit(".png")).alias("file")),
    f"WITH {BLOCKS} SELECT block_id, replace(name, ' ', '-') || '-s' || lpad(CAST(page_no AS VARCHAR), greatest(3, 3), '0') || '.png' AS file FROM blocks WHERE origin IN ('diagram', 'diagramm')",
)
