"""Queries on the quality of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blattwerk.functions import measures as M
from blattwerk.functions import text as T
from blattwerk.operators import gate
from blattwerk.queries.registry import register
from blattwerk.sources.pages import blocks, lines_of
from blattwerk.sources.tables import table

BLOCKS = "blocks AS (SELECT DISTINCT ON (block_id) * FROM page_block)"
LINES = BLOCKS + """, lines AS (
  SELECT block_id, name, page_no, origin, unnest(string_split(markdown, chr(10))) AS text,
    generate_subscripts(string_split(markdown, chr(10)), 1) - 1 AS seq
  FROM blocks WHERE coalesce(markdown, '') <> '')"""
SQUEEZE = "trim(regexp_replace({}, '[\\t\\n\\f\\r\\v ]+', ' ', 'g'))"
TOKENS = f"list_filter(string_split({SQUEEZE.format("coalesce({0}, '')")}, ' '), lambda w: w <> '')"

_SHAPES = f"""
shaped AS (SELECT block_id, list_filter({TOKENS.format("markdown")}, lambda w: regexp_matches(w, '\\p{{L}}')) AS w FROM blocks),
counted AS (SELECT block_id, len(w) AS words, len(list_filter(w, lambda x: length(x) <= 2)) AS isolated,
  len(list_filter(w, lambda x: regexp_matches(x, '\\p{{Ll}}\\p{{Lu}}'))) AS mixed,
  len(list_filter(w, lambda x: regexp_matches(x, '\\p{{Nd}}'))) AS digit_alpha FROM shaped),
scored AS (SELECT block_id, words,
  CASE WHEN words > 0 THEN round((isolated + 3 * mixed + 2 * digit_alpha) / words, 3) ELSE 0.0 END AS garbage,
  CASE WHEN words > 0 THEN round(isolated / words, 3) ELSE 0.0 END AS isolated_share FROM counted)"""

register(
    "quality_gate",
    lambda s, d: gate.garbage_gate(blocks(s, d), "block_id", "markdown"),
    f"WITH {BLOCKS}, {_SHAPES} SELECT *, words < 50 OR (garbage <= 0.40 AND isolated_share <= 0.40) AS passed FROM scored",
)
register(
    "chars_per_page",
    lambda s, d: gate.bytes_per_page(blocks(s, d), "name", "markdown"),
    f"""WITH {BLOCKS}, g AS (SELECT name, count(*) AS pages, sum(strlen(coalesce(markdown, ''))) AS bytes FROM blocks GROUP BY name)
SELECT name, pages, CAST(bytes // pages AS BIGINT) AS bytes_per_page, bytes // pages >= 200 AS dense FROM g""",
)
register(
    "page_floor",
    lambda s, d: blocks(s, d)
    .where((F.char_length(T.squeeze(F.coalesce("markdown", F.lit("")))) < gate.MIN_CHARS) & ~F.coalesce(F.col("origin"), F.lit("")).isin("diagram", "diagramm"))
    .select("block_id", "name", "page_no", F.char_length(T.squeeze(F.coalesce("markdown", F.lit("")))).alias("chars")),
    f"""WITH {BLOCKS}, t AS (SELECT block_id, name, page_no, origin, length({SQUEEZE.format("coalesce(markdown, '')")}) AS chars FROM blocks)
SELECT block_id, name, page_no, chars FROM t WHERE chars < 50 AND coalesce(origin, '') NOT IN ('diagram', 'diagramm')""",
)
register(
    "loop_length",
    lambda s, d: blocks(s, d).select("block_id", gate.loop_length(F.col("markdown")).alias("loop")),
    f"""WITH {BLOCKS}, t AS (SELECT block_id, list_transform({TOKENS.format("markdown")}, lambda w: regexp_replace(w, '[0-9]+', '#', 'g')) AS w FROM blocks),
g AS (SELECT block_id, array_to_string(w[i:i + 4], ' ') AS gram FROM t, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i) WHERE len(w) >= 10),
c AS (SELECT block_id, gram, count(*) AS n FROM g GROUP BY ALL),
m AS (SELECT block_id, max(n) AS loop FROM c GROUP BY block_id)
SELECT block_id, CAST(coalesce(loop, 0) AS INT) AS loop FROM blocks LEFT JOIN m USING (block_id)""",
)


def _expected(s: SparkSession, d: str) -> DataFrame:
    """Each block with the mean length of its preview's pages, which stands for what its ink lets expect."""
    b = blocks(s, d)
    mean = b.groupBy("name").agg(F.avg(F.char_length(F.coalesce("markdown", F.lit("")))).alias("expected"))
    return b.join(mean, "name")


register(
    "derailment",
    lambda s, d: gate.page_verdicts(_expected(s, d), "block_id", "markdown", F.round("expected", 3)).drop("penalty"),
    f"""WITH {BLOCKS}, mean AS (SELECT name, round(avg(length(coalesce(markdown, ''))), 3) AS expected FROM blocks GROUP BY name),
t AS (SELECT block_id, name, coalesce(markdown, '') AS markdown, list_transform({TOKENS.format("markdown")}, lambda w: regexp_replace(w, '[0-9]+', '#', 'g')) AS w FROM blocks),
g AS (SELECT block_id, array_to_string(w[i:i + 4], ' ') AS gram FROM t, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i) WHERE len(w) >= 10),
m AS (SELECT block_id, max(n) AS loop FROM (SELECT block_id, gram, count(*) AS n FROM g GROUP BY ALL) GROUP BY block_id),
c AS (SELECT block_id, CAST(coalesce(loop, 0) AS INT) AS loop, length(markdown) AS chars, expected FROM t JOIN mean USING (name) LEFT JOIN m USING (block_id))
SELECT *, CASE WHEN loop >= 8 THEN 'loop' WHEN expected >= 300 AND chars / expected > 2.6 THEN 'too long' WHEN expected >= 300 AND chars / expected < 0.45 THEN 'cut short' END AS verdict,
  CASE WHEN expected < 300 THEN 8192 ELSE CAST(trunc(least(greatest(expected / 2.2 * 1.8, 1024), 8192)) AS INT) END AS budget FROM c""",
)
register(
    "quality_penalty",
    lambda s, d: gate.page_verdicts(_expected(s, d), "block_id", "markdown", F.round("expected", 3)).select("block_id", "penalty"),
    f"""WITH {BLOCKS}, mean AS (SELECT name, round(avg(length(coalesce(markdown, ''))), 3) AS expected FROM blocks GROUP BY name),
t AS (SELECT block_id, name, coalesce(markdown, '') AS markdown, list_transform({TOKENS.format("markdown")}, lambda w: regexp_replace(w, '[0-9]+', '#', 'g')) AS w FROM blocks),
g AS (SELECT block_id, array_to_string(w[i:i + 4], ' ') AS gram FROM t, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i) WHERE len(w) >= 10),
m AS (SELECT block_id, max(n) AS loop FROM (SELECT block_id, gram, count(*) AS n FROM g GROUP BY ALL) GROUP BY block_id),
c AS (SELECT block_id, coalesce(loop, 0) AS loop, length(markdown) AS chars, expected FROM t JOIN mean USING (name) LEFT JOIN m USING (block_id))
SELECT block_id, round(CASE WHEN loop >= 8 THEN 10.0::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN expected >= 300 THEN abs(ln(greatest(chars, 1) / expected)) ELSE -least(chars, 20000) / 20000 END, 6) AS penalty FROM c""",
)
register(
    "tile_mode",
    lambda s, d: blocks(s, d).select(
        "block_id",
        M.tile_mode(F.coalesce(F.col("layout").startswith("zweispaltig"), F.lit(False)), F.char_length(F.coalesce("markdown", F.lit("")))).alias("mode"),
        M.scanned_page(F.when(F.col("origin") == "ocr", 1.0).otherwise(0.0), F.char_length(F.coalesce("markdown", F.lit("")))).alias("scan"),
    ),
    f"""WITH {BLOCKS} SELECT block_id, CASE WHEN layout LIKE 'zweispaltig%' THEN 'vertical' WHEN length(coalesce(markdown, '')) >= 3000 THEN 'horizontal' ELSE 'whole' END AS mode,
  coalesce(origin = 'ocr', false) OR length(coalesce(markdown, '')) < 100 AS scan FROM blocks""",
)
register(
    "running_lines",
    lambda s, d: gate.running_lines(
        lines_of(blocks(s, d)).join(blocks(s, d).select("block_id", F.size(F.split("markdown", "\n", -1)).alias("n")), "block_id"), "name", "block_id", "text", F.col("seq") / F.col("n")
    ),
    f"""WITH {LINES}, n AS (SELECT block_id, len(string_split(markdown, chr(10))) AS n FROM blocks),
z AS (SELECT name, block_id, trim(regexp_replace(regexp_replace(text, '\\*', '', 'g'), '[\\t\\n\\f\\r\\v ]+', ' ', 'g')) AS line FROM lines JOIN n USING (block_id) WHERE seq / n <= 0.09 OR seq / n >= 0.93)
SELECT name, line, count(DISTINCT block_id) AS pages FROM z WHERE length(line) >= 6 AND NOT regexp_matches(line, '^[0-9\\t\\n\\f\\r\\v \\-–—]*$') GROUP BY ALL HAVING count(DISTINCT block_id) >= 2""",
)
register(
    "origin_counters",
    lambda s, d: blocks(s, d)
    .groupBy("name")
    .agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("origin") == "textlayer").alias("pages_textlayer"),
        F.count_if(F.col("origin") == "ocr").alias("pages_ocr"),
        F.count_if(F.col("origin").isin("diagram", "diagramm")).alias("pages_diagram"),
    ),
    f"""WITH {BLOCKS} SELECT name, count(*) AS pages, count(*) FILTER (origin = 'textlayer') AS pages_textlayer,
  count(*) FILTER (origin = 'ocr') AS pages_ocr, count(*) FILTER (origin IN ('diagram', 'diagramm')) AS pages_diagram FROM blocks GROUP BY name""",
)
register(
    "repeated_line_flag",
    lambda s, d: lines_of(blocks(s, d)).where(F.trim("text") != "").groupBy("block_id", "text").count().groupBy("block_id").agg(F.max("count").alias("most")).select("block_id", "most", (F.col("most") > 5).alias("looped")),
    f"WITH {LINES}, c AS (SELECT block_id, text, count(*) AS n FROM lines WHERE trim(text) <> '' GROUP BY ALL) SELECT block_id, max(n) AS most, max(n) > 5 AS looped FROM c GROUP BY block_id",
)
register(
    "distinct_sets",
    lambda s, d: blocks(s, d).groupBy("source_pdf").agg(F.countDistinct("name").alias("names"), F.countDistinct("name", "page_no").alias("pages")),
    f"WITH {BLOCKS} SELECT source_pdf, count(DISTINCT name) AS names, count(DISTINCT CASE WHEN name IS NOT NULL AND page_no IS NOT NULL THEN (name, page_no) END) AS pages FROM blocks GROUP BY source_pdf",
)
register(
    "page_density_quantile",
    lambda s, d: blocks(s, d).groupBy("name").agg(F.expr("percentile(char_length(coalesce(markdown, '')), 0.6)").alias("q60"), F.expr("percentile(char_length(coalesce(markdown, '')), 0.5)").alias("median")),
    f"WITH {BLOCKS} SELECT name, quantile_cont(length(coalesce(markdown, '')), 0.6) AS q60, quantile_cont(length(coalesce(markdown, '')), 0.5) AS median FROM blocks GROUP BY name",
)
register(
    "sample_mid_pages",
    lambda s, d: _mid_pages(s, d),
    f"""WITH {BLOCKS}, e AS (SELECT name, page_no, block_id, length(markdown) AS chars FROM blocks WHERE coalesce(origin, '') NOT IN ('ocr', 'diagram', 'diagramm') AND length(markdown) BETWEEN 500 AND 2000),
r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY page_no, block_id) AS rn, count(*) OVER (PARTITION BY name) AS n FROM e)
SELECT name, page_no, block_id, chars FROM r WHERE rn = n // 2 + 1""",
)


def _mid_pages(s: SparkSession, d: str) -> DataFrame:
    """The middle eligible page of each preview, found by its rank."""
    from pyspark.sql import Window

    e = blocks(s, d).where(~F.coalesce(F.col("origin"), F.lit("")).isin("ocr", "diagram", "diagramm") & F.char_length("markdown").between(500, 2000))
    w = Window.partitionBy("name")
    r = e.select("name", "page_no", "block_id", F.char_length("markdown").alias("chars"), F.row_number().over(w.orderBy("page_no", "block_id")).alias("rn"), F.count(F.lit(1)).over(w).alias("n"))
    return r.where(F.expr("rn = n div 2 + 1")).select("name", "page_no", "block_id", "chars")


register(
    "seeded_sample",
    lambda s, d: blocks(s, d).where(F.conv(F.substring(F.md5(F.concat_ws("-", F.lit("7"), F.col("block_id").cast("string"))), 1, 8), 16, 10).cast("bigint") % 100 < 10).select("block_id", "name", "page_no"),
    f"WITH {BLOCKS} SELECT block_id, name, page_no FROM blocks WHERE CAST('0x' || substr(md5('7-' || block_id), 1, 8) AS BIGINT) % 100 < 10",
)
register(
    "status_chips",
    lambda s, d: table(s, d, "manifest").agg(
        F.count(F.lit(1)).alias("all_rows"),
        F.count_if(F.col("status").isin("open", "re-created")).alias("open_rows"),
        F.count_if(F.col("status") == "accepted").alias("accepted_rows"),
        F.count_if(F.col("status") == "rejected").alias("rejected_rows"),
    ),
    """SELECT count(*) AS all_rows, count(*) FILTER (status IN ('open', 're-created')) AS open_rows, count(*) FILTER (status = 'accepted') AS accepted_rows,
  count(*) FILTER (status = 'rejected') AS rejected_rows FROM manifest""",
)
