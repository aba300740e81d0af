"""Queries of small table operators: selections, pairings, geometry, JSON, verdicts by direction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blattwerk.functions import measures as M
from blattwerk.functions import text as T
from blattwerk.operators import boundary
from blattwerk.operators import review as R
from blattwerk.queries.lines import BOXED
from blattwerk.queries.quality import BLOCKS
from blattwerk.queries.registry import register
from blattwerk.sources import manifest as J
from blattwerk.sources import parse
from blattwerk.sources.pages import blocks, boxed, lines_of
from blattwerk.sources.tables import table

register(
    "page_selection",
    lambda s, d: blocks(s, d).join(table(s, d, "preview").select("name", F.explode(parse.page_selection(F.lit("1,3-5,9"), F.col("pages"), strict=False)).alias("page_no")).distinct(), ["name", "page_no"], "left_semi").select("block_id"),
    f"WITH {BLOCKS} SELECT block_id FROM blocks b WHERE page_no IN (1, 3, 4, 5, 9) AND EXISTS (SELECT 1 FROM preview p WHERE p.name = b.name AND p.pages >= b.page_no)",
)
register(
    "forced_diagrams",
    lambda s, d: blocks(s, d).select("block_id", (F.coalesce(F.col("origin").isin("diagram", "diagramm"), F.lit(False)) | F.coalesce(F.col("page_no").isin(2, 7), F.lit(False))).alias("diagram")),
    f"WITH {BLOCKS} SELECT block_id, coalesce(origin IN ('diagram', 'diagramm'), false) OR coalesce(page_no IN (2, 7), false) AS diagram FROM blocks",
)
register(
    "geometry",
    lambda s, d: boxed(lines_of(blocks(s, d))).select(
        "block_id", "seq",
        M.per_mille(F.col("x0") * 0.595, F.lit(595.0)).alias("px"), M.overlap(F.col("x0"), F.col("x1"), F.lit(200), F.lit(700)).alias("shared"),
        F.round(M.ink_at(F.col("x1").cast("double"), F.lit(300)), 6).alias("ink"), F.least(F.lit(1800.0) / F.greatest("x1", "y1"), F.lit(4.0)).alias("scale"),
        (F.lit(0.48) * 1000 + F.col("y0") * 0.52).cast("int").alias("page_y"),
    ),
    f"""WITH {BOXED} SELECT block_id, seq, CAST(trunc(CAST(x0 AS DOUBLE) * 0.595::DOUBLE / 595.0::DOUBLE * 1000) AS INT) AS px, least(x1, 700) - greatest(x0, 200) AS shared, round(x1 * 0.25::DOUBLE, 6) AS ink,
  least(1800.0::DOUBLE / greatest(x1, y1), 4.0::DOUBLE) AS scale, CAST(trunc(0.48::DOUBLE * 1000 + y0 * 0.52::DOUBLE) AS INT) AS page_y FROM boxed""",
)
register(
    "positional_zip",
    lambda s, d: _zip(s, d),
    f"""WITH {BLOCKS}, a AS (SELECT name, block_id, row_number() OVER (PARTITION BY name ORDER BY page_no, block_id) AS i FROM blocks WHERE name IS NOT NULL),
n AS (SELECT a.name, count(*) AS have, max(p.pages) AS want FROM a LEFT JOIN preview p USING (name) GROUP BY a.name) SELECT name, have, want, have = want AS agrees FROM n""",
)


def _zip(s: SparkSession, d: str) -> DataFrame:
    """Pages against the number that their preview announces: a mismatch is told, not mended."""
    n = blocks(s, d).where("name IS NOT NULL").groupBy("name").agg(F.count(F.lit(1)).alias("have"))
    want = table(s, d, "preview").groupBy("name").agg(F.max("pages").alias("want"))
    return n.join(want, "name", "left").withColumn("agrees", F.col("have") == F.col("want"))


register(
    "baseline_pairs",
    lambda s, d: _baseline(s, d),
    """WITH f AS (SELECT DISTINCT regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\\.[A-Za-z0-9]{1,4}$', '') AS stem FROM found_file WHERE path IS NOT NULL),
p AS (SELECT substr(stem, 1, 5) AS k, min(stem) AS by_prefix FROM f GROUP BY ALL)
SELECT name, coalesce(f.stem, by_prefix) AS baseline FROM preview LEFT JOIN f ON f.stem = name LEFT JOIN p ON p.k = substr(name, 1, 5)""",
)


def _baseline(s: SparkSession, d: str) -> DataFrame:
    """The file of the same stem, else the first one whose stem begins alike."""
    f = table(s, d, "found_file").where("path IS NOT NULL").select(R.stem(F.col("path")).alias("stem")).distinct()
    p = f.groupBy(F.substring("stem", 1, 5).alias("k")).agg(F.min("stem").alias("by_prefix"))
    v = table(s, d, "preview")
    j = v.join(f, v["name"] == f["stem"], "left").join(p, F.substring("name", 1, 5) == F.col("k"), "left")
    return j.select("name", F.coalesce("stem", "by_prefix").alias("baseline"))


register(
    "named_sources",
    lambda s, d: _named(s, d),
    """WITH t AS (SELECT DISTINCT source FROM mix_target) SELECT t.source, count(DISTINCT doc_id) AS documents, min(doc_id) AS first FROM t JOIN documents d ON contains(lower(d.source), t.source) GROUP BY t.source""",
)


def _named(s: SparkSession, d: str) -> DataFrame:
    """Documents whose source contains a wanted name. The wanted names are few and counted before they are broadcast."""
    from blattwerk.plans import broadcast_if_small

    t = broadcast_if_small(table(s, d, "mix_target").select("source").distinct(), 10_000)
    docs = table(s, d, "documents").select("doc_id", F.lower("source").alias("of"))
    return docs.join(t, F.col("of").contains(F.col("source"))).groupBy("source").agg(F.countDistinct("doc_id").alias("documents"), F.min("doc_id").alias("first"))


register(
    "verdicts_by_direction",
    lambda s, d: _directions(s, d),
    f"""WITH {BLOCKS}, t AS (SELECT origin = 'ocr' AS truth, length(markdown) < 400 AS by_size, contains(markdown, '-' || chr(10)) AS by_break FROM blocks WHERE origin IS NOT NULL AND markdown IS NOT NULL),
u AS (SELECT 'by_size' AS rule, truth, by_size AS said FROM t UNION ALL SELECT 'by_break', truth, by_break FROM t)
SELECT rule, CASE WHEN truth = said THEN 'right' WHEN said THEN 'false alarm' ELSE 'missed' END AS direction, count(*) AS n FROM u GROUP BY ALL""",
)


def _directions(s: SparkSession, d: str) -> DataFrame:
    """Two rules that guess whether a page was scanned, by the direction of their errors."""
    t = blocks(s, d).where("origin IS NOT NULL AND markdown IS NOT NULL").select((F.col("origin") == "ocr").alias("truth"), (F.char_length("markdown") < 400).alias("by_size"), F.col("markdown").contains("-\n").alias("by_break"))
    u = t.unpivot(["truth"], ["by_size", "by_break"], "rule", "said")
    direction = F.when(F.col("truth") == F.col("said"), "right").when(F.col("said"), "false alarm").otherwise("missed")
    return u.groupBy("rule", direction.alias("direction")).agg(F.count(F.lit(1)).alias("n"))


register(
    "rule_regression",
    lambda s, d: boundary.compare_rules(blocks(s, d).where("markdown IS NOT NULL"), "block_id", F.col("markdown"), F.regexp_replace("markdown", r"(\p{L})-\n(\p{Ll})", "$1$2")),
    f"""WITH {BLOCKS}, r AS (SELECT markdown AS a, regexp_replace(markdown, '(\\p{{L}})-\\n(\\p{{Ll}})', '\\1\\2', 'g') AS b FROM blocks WHERE markdown IS NOT NULL),
w AS (SELECT a, b, list_sort(list_filter(string_split_regex(a, '[\\t\\n\\f\\r\\v ]+'), lambda x: x <> '')) AS wa, list_sort(list_filter(string_split_regex(b, '[\\t\\n\\f\\r\\v ]+'), lambda x: x <> '')) AS wb,
  list_sort(string_split(regexp_replace(a, '[\\t\\n\\f\\r\\v *#>|-]+', '', 'g'), '')) AS ca, list_sort(string_split(regexp_replace(b, '[\\t\\n\\f\\r\\v *#>|-]+', '', 'g'), '')) AS cb FROM r)
SELECT CASE WHEN a = b THEN 'unchanged' WHEN len(list_filter(list_distinct(ca), lambda c: len(list_filter(ca, lambda x: x = c)) > len(list_filter(cb, lambda x: x = c)))) > 0 THEN 'lost' WHEN wa <> wb THEN 'hyphens resolved' ELSE 'reordered' END AS change, count(*) AS n FROM w GROUP BY ALL""",
)
register(
    "evicted_buffers",
    lambda s, d: _evicted(s, d),
    """WITH u AS (SELECT user_id, event_id % 40 AS page, max(ts) AS used FROM events GROUP BY ALL) SELECT user_id, page FROM u QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY used DESC, page) > 12""",
)


def _evicted(s: SparkSession, d: str) -> DataFrame:
    """Pages beyond the twelve that each user looked at last."""
    u = table(s, d, "events").groupBy("user_id", (F.col("event_id") % 40).alias("page")).agg(F.max("ts").alias("used"))
    return u.withColumn("r", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("used"), "page"))).where("r > 12").select("user_id", "page")


register(
    "next_entries",
    lambda s, d: R.latest_states(table(s, d, "manifest")).where("status = 'open'").select("name", F.lead("name").over(Window.partitionBy(F.substring("name", 1, 4)).orderBy("name")).alias("next")),
    "WITH st AS (SELECT * FROM manifest WHERE name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY updated DESC NULLS LAST, loaded_at DESC NULLS LAST, status DESC NULLS LAST) = 1) SELECT name, lead(name) OVER (PARTITION BY substr(name, 1, 4) ORDER BY name) AS next FROM st WHERE status = 'open'",
)
register(
    "manifest_round_trip",
    lambda s, d: J.read_entries(J.manifest_of(R.latest_states(table(s, d, "manifest")), "2026-01-01T00:00:00"), "json").select("name", "status", "path", "pages", "decided"),
    """WITH st AS (SELECT * FROM manifest WHERE name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY updated DESC NULLS LAST, loaded_at DESC NULLS LAST, status DESC NULLS LAST) = 1)
SELECT name, CASE WHEN status IN ('open', 'offen') THEN 'open' WHEN status IN ('accepted', 'akzeptiert') THEN 'accepted' WHEN status IN ('rejected', 'abgelehnt') THEN 'rejected' WHEN status IN ('re-created', 'neu-erzeugt') THEN 're-created'
  WHEN status IN ('adopted', 'uebernommen') THEN 'adopted' ELSE 'open' END AS status, nullif(path, '') AS path, pages, nullif(decided, '') AS decided FROM st""",
)
register(
    "event_properties",
    lambda s, d: table(s, d, "events").select("event_id", F.from_json("props", "map<string,string>").alias("m")).select("event_id", F.explode("m").alias("key", "val")).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("val").alias("values")),
    "WITH m AS (SELECT unnest(json_keys(props)) AS key, props FROM events), v AS (SELECT key, props ->> key AS val FROM m) SELECT key, count(*) AS n, count(DISTINCT val) AS values FROM v GROUP BY key",
)
register(
    "plain_words",
    lambda s, d: blocks(s, d).where("markdown IS NOT NULL").select("block_id", F.size(T.word_list(T.plain_text(F.col("markdown")))).alias("words"), F.size(T.tokens(F.col("markdown"))).alias("tokens"), F.size(T.citations(F.col("markdown"))).alias("citations")),
    f"""WITH {BLOCKS}, b AS (SELECT block_id, markdown FROM blocks WHERE markdown IS NOT NULL), p AS (SELECT block_id, markdown, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(markdown, '(?s)%%.*?%%', ' ', 'g'),
  '!\\[\\[.*?\\]\\]', ' ', 'g'), '(?m)^[\\t\\n\\f\\r\\v ]*>[\\t\\n\\f\\r\\v ]?', '', 'g'), '(?m)^#{{1,6}}[\\t\\n\\f\\r\\v ]*', '', 'g'), '\\[\\^([0-9]+)\\]:?', ' \\1 ', 'g'), '\\*\\*|\\|', ' ', 'g'), '[\\t\\n\\f\\r\\v ]+', ' ', 'g')) AS plain FROM b)
SELECT block_id, CAST(len(regexp_extract_all(plain, '[\\p{{L}}\\p{{N}}_§€%]+')) AS INT) AS words, CAST(len(regexp_extract_all(markdown, '[^\\t\\n\\f\\r\\v ]+')) AS INT) AS tokens,
  CAST(len(regexp_extract_all(markdown, '(?:§{{1,2}}|Art\\.)[\\t\\n\\f\\r\\v ]*[0-9]+[a-z]?')) AS INT) AS citations FROM p""",
)
register(
    "timing_totals",
    # the parts of a run are a user's events of a day
    lambda s, d: table(s, d, "events").groupBy("user_id", F.to_date("ts").cast("string").alias("day")).agg(
        F.round(F.sum(F.when(F.col("event_type") == "view", F.col("value"))), 3).alias("prefill"), F.round(F.sum(F.when(F.col("event_type") != "view", F.col("value"))), 3).alias("decode"), F.count(F.lit(1)).alias("parts"), F.max("value").alias("peak")
    ),
    """SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, round(sum(value) FILTER (event_type = 'view'), 3) AS prefill, round(sum(value) FILTER (event_type <> 'view'), 3) AS decode, count(*) AS parts, max(value) AS peak FROM events GROUP BY ALL""",
)
register("named_citations", lambda s, d: blocks(s, d).select("block_id", F.explode(T.named_citations(F.col("markdown"))).alias("citation")).groupBy("block_id", "citation").agg(F.count(F.lit(1)).alias("n")))
