"""Queries on the layout of pages. The page tables hold no boxes or rasters, so both follow from the lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blattwerk.operators import layout as L
from blattwerk.operators import sequences as S
from blattwerk.queries.joins import _BOX, BEGINNING, NUMBERED, SECTIONED, _boxes, _lines
from blattwerk.queries.lines import BOXED
from blattwerk.queries.quality import LINES
from blattwerk.queries.registry import register
from blattwerk.queries.text import clean_sql
from blattwerk.sources.pages import blocks, boxed, lines_of


def _boxed(s: SparkSession, d: str) -> DataFrame:
    return boxed(lines_of(blocks(s, d))).select("block_id", "seq", "text", "x0", "y0", "x1", "y1")


def _profile(s: SparkSession, d: str) -> DataFrame:
    """Lines over each column of a hundred."""
    x = F.explode(F.sequence(F.floor(F.col("x0") / 10).cast("int"), F.floor(F.col("x1") / 10).cast("int")))
    return _lines(s, d).select("block_id", x.alias("x")).groupBy("block_id", "x").agg(F.count(F.lit(1)).cast("double").alias("ink"))


_PROFILE = BOXED + ", profile AS (SELECT block_id, x, CAST(count(*) AS DOUBLE) AS ink FROM (SELECT block_id, unnest(range(CAST(x0 // 10 AS BIGINT), CAST(x1 // 10 AS BIGINT) + 1)) AS x FROM boxed) GROUP BY ALL)"
_GUTTER = _PROFILE + """, ref AS (SELECT block_id, quantile_cont(ink, 0.6) AS ref FROM profile WHERE x >= 10 AND x < 90 GROUP BY block_id HAVING quantile_cont(ink, 0.6) > 0),
low AS (SELECT p.block_id, x, ref, x - lag(x) OVER (PARTITION BY p.block_id ORDER BY x) - 1 > 1 AS fresh FROM profile p JOIN ref USING (block_id) WHERE x >= 30 AND x < 70 AND ink < ref * 0.35),
r AS (SELECT block_id, x, ref, coalesce(sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY block_id ORDER BY x), 0) AS run FROM low),
t AS (SELECT block_id, run, ref, min(x) AS a, max(x) + 1 AS b FROM r GROUP BY ALL HAVING (max(x) + 1 - min(x)) / 100 >= 0.015),
m AS (SELECT t.block_id, run, ref, a, b, median(ink) FILTER (x BETWEEN a - 5 AND a - 1) AS l, median(ink) FILTER (x BETWEEN b AND b + 4) AS r FROM t JOIN profile USING (block_id) GROUP BY ALL),
gut AS (SELECT block_id, ((a + b) // 2) / 100 AS center, (b - a) / 100 AS wide FROM m WHERE l >= ref * 0.35 AND r >= ref * 0.35 QUALIFY row_number() OVER (PARTITION BY block_id ORDER BY b - a DESC, a) = 1)"""
register("ink_profile", lambda s, d: _profile(s, d), f"WITH {_PROFILE} SELECT block_id, CAST(x AS INT) AS x, ink FROM profile")
register(
    "gutter_ink",
    lambda s, d: L.gutter(_profile(s, d), "block_id", 100).select("block_id", F.round("center", 6).alias("center"), F.round("wide", 6).alias("wide")),
    f"WITH {_GUTTER} SELECT block_id, round(center, 6) AS center, round(wide, 6) AS wide FROM gut",
)
register(
    "single_valley",
    lambda s, d: L.single_valley(_profile(s, d), "block_id", 100).select("block_id", F.round("center", 6).alias("center"), F.round("wide", 6).alias("wide")),
    f"""WITH {_PROFILE}, ref AS (SELECT block_id, median(ink) AS ref FROM profile WHERE x >= 10 AND x < 90 GROUP BY block_id HAVING median(ink) > 0),
low AS (SELECT block_id, x, x - row_number() OVER (PARTITION BY block_id ORDER BY x) AS g FROM profile JOIN ref USING (block_id) WHERE x >= 30 AND x < 70 AND ink < ref * 0.25),
t AS (SELECT block_id, min(x) AS a, max(x) + 1 AS b FROM low GROUP BY block_id, g)
SELECT block_id, round(((a + b) // 2) / 100, 6) AS center, round((b - a) / 100, 6) AS wide FROM (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY block_id ORDER BY b - a DESC, a) = 1) WHERE (b - a) / 100 >= 0.01""",
)
_EDGES = BOXED + ", m AS (SELECT block_id, unnest(range(100)) AS x FROM (SELECT DISTINCT block_id FROM boxed)), edges AS (SELECT m.block_id, m.x, count(b.seq) AS edges FROM m LEFT JOIN boxed b ON b.block_id = m.block_id AND b.x0 // 10 = m.x GROUP BY ALL)"


def _edges(s: SparkSession, d: str) -> DataFrame:
    """Beginnings of lines over each column of a hundred, those without any too."""
    x = _lines(s, d)
    every = x.select("block_id").distinct().select("block_id", F.explode(F.sequence(F.lit(0), F.lit(99))).alias("x"))
    n = x.groupBy("block_id", F.floor(F.col("x0") / 10).cast("int").alias("x")).agg(F.count(F.lit(1)).alias("edges"))
    return every.join(n, ["block_id", "x"], "left").withColumn("edges", F.coalesce("edges", F.lit(0)))


register(
    "edge_valley",
    lambda s, d: L.edge_valley(_edges(s, d), "block_id", 100),
    f"""WITH {_EDGES}, w AS (SELECT block_id, x, sum(edges) OVER (PARTITION BY block_id ORDER BY x ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS total FROM edges)
SELECT block_id, coalesce(min(total) FILTER (x >= 40 AND x < 58) / greatest(max(total) FILTER (x < 40), 1) < 0.4, false) AS two_columns FROM w WHERE x <= 97 GROUP BY block_id""",
)
register(
    "slanted_drawings",
    # the stroke from the beginning of a line to the end of the next one; a drawing is the lines of a row
    lambda s, d: L.slanted(_strokes(s, d), "block_id", "drawing"),
    f"""WITH {BOXED}, s AS (SELECT block_id, y0 AS drawing, x0, y0, lead(x1) OVER w AS x1, lead(y1) OVER w AS y1 FROM boxed WINDOW w AS (PARTITION BY block_id ORDER BY seq))
SELECT block_id, count(DISTINCT drawing) AS slanted FROM s WHERE abs(x1 - x0) > 10 AND abs(y1 - y0) > 10 GROUP BY block_id""",
)


def _strokes(s: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("block_id").orderBy("seq")
    return _lines(s, d).select("block_id", F.col("y0").alias("drawing"), "x0", "y0", F.lead("x1").over(w).alias("x1"), F.lead("y1").over(w).alias("y1"))


def _rules(s: SparkSession, d: str) -> DataFrame:
    """A rule under every numbered line, and one along each edge at which lines begin."""
    across = _boxes(s, d).select("block_id", F.lit(True).alias("across"), F.col("y1").cast("double").alias("at"))
    return across.unionByName(_lines(s, d).select("block_id", F.lit(False).alias("across"), (F.floor(F.col("x0") / 100) * 100).cast("double").alias("at"))).distinct()


_RULES = f"{BOXED}, rules AS (SELECT block_id, true AS across, CAST(y1 + 30 AS DOUBLE) AS place FROM boxed WHERE regexp_matches(text, '{NUMBERED}') UNION SELECT block_id, false, CAST(x0 // 100 * 100 AS DOUBLE) FROM boxed)"
register("gridded_pages", lambda s, d: L.gridded(_rules(s, d), "block_id"), f"WITH {_RULES} SELECT block_id, count(*) FILTER (across) >= 3 AND count(*) FILTER (NOT across) >= 1 AS grid FROM rules GROUP BY block_id")
register(
    "cells_of_rules",
    lambda s, d: L.cells_of_rules(_rules(s, d), "block_id", 1000.0, 1000.0),
    f"""WITH {_RULES}, g AS (SELECT block_id, across, place, lead(place) OVER (PARTITION BY block_id, across ORDER BY place) AS upto FROM rules)
SELECT r.block_id, c.place AS x0, r.place AS y0, c.upto AS x1, r.upto AS y1 FROM g r JOIN g c USING (block_id) WHERE r.across AND NOT c.across AND r.upto - r.place >= 20 AND c.upto - c.place >= 80""",
)
register(
    "layouts",
    lambda s, d: L.layouts(blocks(s, d).select("block_id"), L.gutter(_profile(s, d), "block_id", 100), S.edge_ratio(_lines(s, d), "block_id", F.lit(0.5)), "block_id"),
    f"""WITH {_GUTTER}, e AS (SELECT block_id, CASE WHEN count(*) >= 20 THEN round(avg(CASE WHEN x1 / 1000 BETWEEN 0.35 AND 0.6 THEN 1.0 ELSE 0.0 END), 9) END AS ratio FROM boxed GROUP BY block_id),
j AS (SELECT block_id, center, coalesce(center IS NOT NULL AND CASE WHEN ratio IS NOT NULL THEN ratio >= 0.30 ELSE wide >= 0.010 END, false) AS two FROM blocks LEFT JOIN gut USING (block_id) LEFT JOIN e USING (block_id))
SELECT block_id, two AS two_columns, CASE WHEN two THEN center END AS gutter FROM j""",
)
register(
    "region_columns",
    lambda s, d: L.region_columns(_boxed(s, d).withColumn("class", F.when(F.col("text").rlike(NUMBERED), "head").otherwise("text")), "block_id", ["text"]).select("block_id", "two_columns"),
    f"""WITH {BOXED}, r AS (SELECT block_id, x0, x1, max(x1) OVER p - min(x0) OVER p AS span FROM boxed WHERE NOT regexp_matches(text, '{NUMBERED}') WINDOW p AS (PARTITION BY block_id)),
n AS (SELECT *, count(*) OVER (PARTITION BY block_id) AS n FROM (SELECT * FROM r WHERE x1 - x0 <= 0.6 * span AND span > 0)),
u AS (SELECT block_id, x0 AS a, x1 AS b FROM n WHERE n >= 2 UNION ALL SELECT DISTINCT block_id, 700, 700 FROM n WHERE n >= 2),
g AS (SELECT block_id, greatest(coalesce(max(b) OVER (PARTITION BY block_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 300), 300) AS f, least(a, 700) AS t FROM u),
m AS (SELECT block_id, (f + t) // 2 AS mid FROM g WHERE t - f >= 15 QUALIFY row_number() OVER (PARTITION BY block_id ORDER BY t - f DESC, f) = 1),
k AS (SELECT block_id FROM n JOIN m USING (block_id) WHERE n >= 2 GROUP BY block_id, n HAVING least(count(*) FILTER (x1 <= mid), count(*) FILTER (x0 >= mid)) / n >= 0.25)
SELECT block_id, block_id IN (SELECT block_id FROM k) AS two_columns FROM (SELECT DISTINCT block_id FROM boxed)""",
)
register("reading_order", lambda s, d: L.reading_order(_boxed(s, d), "block_id").select("block_id", "seq", "ord"))
register("distinct_boxes", lambda s, d: L.distinct_boxes(_boxes(s, d, BEGINNING), "block_id"))
register("stacked_boxes", lambda s, d: L.stacked_boxes(_boxes(s, d, BEGINNING), "block_id"))
_DETECTED = f"""{BOXED}, raw AS ({_BOX.format(NUMBERED)}), frames AS ({_BOX.format(SECTIONED)}),
kb AS (SELECT block_id, x0, y0, x1, y1, row_number() OVER (PARTITION BY block_id ORDER BY y0, x0, y1, x1) AS box_id FROM raw r WHERE (x1 - x0) * (y1 - y0) < 750000 AND y1 - y0 < 850 AND x1 - x0 < 920
  AND NOT EXISTS (SELECT 1 FROM frames f WHERE f.block_id = r.block_id AND (r.x0 + r.x1) / 2 BETWEEN f.x0 AND f.x1 AND (r.y0 + r.y1) / 2 BETWEEN f.y0 AND f.y1)),
held AS (SELECT k.block_id, k.box_id, count(*) AS lines FROM kb k JOIN boxed l ON l.block_id = k.block_id AND (l.x0 + l.x1) / 2 BETWEEN k.x0 AND k.x1 AND (l.y0 + l.y1) / 2 BETWEEN k.y0 AND k.y1 GROUP BY ALL),
kept AS (SELECT kb.*, lines FROM kb JOIN held USING (block_id, box_id)), multi AS (SELECT * FROM kept WHERE lines >= 2)"""
register(
    "detected_boxes",
    lambda s, d: L.detected_boxes(_boxes(s, d), _lines(s, d), _boxes(s, d, SECTIONED), "block_id")[0].select("block_id", "box_id", "lines"),
    f"WITH {_DETECTED} SELECT block_id, CAST(box_id AS INT) AS box_id, lines FROM multi",
)
register(
    "drawings",
    lambda s, d: L.detected_boxes(_boxes(s, d), _lines(s, d), _boxes(s, d, SECTIONED), "block_id")[1],
    f"""WITH {_DETECTED}, w AS (SELECT block_id, (x1 - x0) / 1000 AS width FROM kept), g AS (SELECT *, width - lag(width) OVER (PARTITION BY block_id ORDER BY width) > 0.05 AS fresh FROM w),
s AS (SELECT block_id, count(*) >= 3 AND count(*) FILTER (fresh) >= 2 AND round(stddev_pop(width), 9) >= 0.05 AS spread FROM g GROUP BY block_id),
t AS (SELECT DISTINCT p.block_id FROM multi p JOIN multi q ON p.block_id = q.block_id AND p.box_id < q.box_id WHERE least(p.y1, q.y1) - greatest(p.y0, q.y0) > 0.4 * least(p.y1 - p.y0, q.y1 - q.y0) AND (p.x1 <= q.x0 + 8 OR q.x1 <= p.x0 + 8))
SELECT block_id, coalesce(spread, false) OR block_id IN (SELECT block_id FROM t) AS diagram FROM (SELECT DISTINCT block_id FROM boxed) LEFT JOIN s USING (block_id)""",
)
register(
    "bold_lines_by_ink",
    lambda s, d: L.bold_lines(_boxed(s, d).withColumns({"density": ((F.col("seq") * 7) % 13).cast("double"), "height": F.col("y1") - F.col("y0")}), "block_id").select("block_id", "seq", "text"),
    f"""WITH {BOXED}, d AS (SELECT *, CAST((seq * 7) % 13 AS DOUBLE) AS density, x1 - x0 AS w FROM boxed), m AS (SELECT *, count(*) OVER p AS n, median(density) OVER p AS mid, max(w) OVER p AS most FROM d WINDOW p AS (PARTITION BY block_id))
SELECT block_id, seq, CASE WHEN n >= 5 AND mid > 0 AND density > mid * 1.45 AND w / greatest(most, 1) <= 0.75 AND NOT starts_with(trim(text), '**') THEN '**' || trim(text) || '**' ELSE text END AS text FROM m""",
)


def _cells(s: SparkSession, d: str) -> DataFrame:
    """Cells of the tables that pages hold as text."""
    rows = lines_of(blocks(s, d)).where(F.col("text").startswith("|") & ~F.col("text").rlike(r"^[|\s-]+$"))
    cut = F.split(F.regexp_replace(F.trim("text"), r"^\|\s*|\s*\|$", ""), r"\s*\|\s*")
    return rows.select("block_id", F.col("seq").alias("row"), F.posexplode(cut).alias("col", "text"), F.lit(False).alias("bold"))


register(
    "ruled_tables",
    lambda s, d: L.ruled_tables(_cells(s, d), ["block_id"]),
    f"""WITH {LINES}, r AS (SELECT block_id, seq AS row, string_split_regex(regexp_replace(trim(text), '^\\|[\t\n\f\r\v ]*|[\t\n\f\r\v ]*\\|$', '', 'g'), '[\t\n\f\r\v ]*\\|[\t\n\f\r\v ]*') AS cs
  FROM lines WHERE starts_with(text, '|') AND NOT regexp_full_match(text, '[|\t\n\f\r\v -]+')),
c AS (SELECT block_id, row, unnest(range(len(cs))) AS col, regexp_replace(replace(trim(unnest(cs)), '|', '\\|'), '[\t\n\f\r\v ]+', ' ', 'g') AS text FROM r),
f AS (SELECT *, max(CASE WHEN text <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY block_id, row) AS rf, max(CASE WHEN text <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY block_id, col) AS cf FROM c),
l AS (SELECT block_id, row, '| ' || string_agg(text, ' | ' ORDER BY col, text) || ' |' AS line, count(*) FILTER (text <> '') AS filled, count(*) AS wide FROM f WHERE rf = 1 AND cf = 1 GROUP BY ALL),
t AS (SELECT block_id, list(line ORDER BY row) AS ls, max(wide) AS w FROM l GROUP BY block_id HAVING count(*) >= 2 AND max(wide) >= 2 AND count(*) FILTER (filled >= 2) >= 2)
SELECT block_id, ls[1] || chr(10) || '|' || repeat(' --- |', CAST(w AS INT)) || chr(10) || array_to_string(ls[2:], chr(10)) AS markdown FROM t""",
)
register("answer_tables", lambda s, d: L.answer_tables(_boxed(s, d).withColumn("side", F.when(F.col("x0") < 500, "l").otherwise("r")), "block_id"))
register(
    "joined_fragments",
    lambda s, d: L.joined_fragments(_boxed(s, d), "block_id", 1000.0),
    # rows do not overlap here and the columns stand far apart, so what must come out is the order
    f"""WITH {BOXED} SELECT block_id, CAST(row_number() OVER (PARTITION BY block_id ORDER BY y0, x0, seq) - 1 AS INT) AS i, text, x0::DOUBLE AS x0, y0::DOUBLE AS y0, x1::DOUBLE AS x1, y1::DOUBLE AS y1 FROM boxed""",
)


def _spans(s: SparkSession, d: str) -> DataFrame:
    """Every line as one span, bold if it has a number, upright if it has the sign of a section."""
    flags = F.when(F.col("text").rlike(NUMBERED), 16).otherwise(0)
    return _boxed(s, d).select("block_id", F.col("seq").alias("line"), F.lit(0).alias("span"), "text", F.lit("Times").alias("font"), flags.alias("flags"), F.col("text").rlike(SECTIONED).alias("upright"), "x0", "y0", "x1", "y1")


register(
    "text_lines",
    lambda s, d: L.text_lines(_spans(s, d), "block_id", width=1000.0, height=1000.0),
    f"""WITH {BOXED}, c AS (SELECT block_id, seq, x0, y0, x1, y1, regexp_matches(text, '{SECTIONED}') AS up, regexp_matches(text, '{NUMBERED}') AS bold, {clean_sql()} AS t FROM boxed),
l AS (SELECT *, trim(CASE WHEN bold AND trim(t) <> '' THEN regexp_extract(t, '^([\\t\\n\\f\\r\\v ]*)', 1) || '**' || trim(t) || '**' ELSE t END) AS text FROM c)
SELECT block_id, CAST(row_number() OVER (PARTITION BY block_id ORDER BY up, CASE WHEN up THEN 0 ELSE y0 END, CASE WHEN up THEN seq ELSE x0 END, seq) - 1 AS INT) AS seq, text, x0, y0, x1, y1, CAST(NULL AS VARCHAR) AS marker FROM l WHERE text <> ''""",
)
register(
    "numbered_notes",
    lambda s, d: L.numbered_notes(_boxed(s, d).withColumns({"y0": F.col("y0") + 600, "y1": F.col("y1") + 600}), "block_id"),
    f"""WITH {BOXED}, n AS (SELECT block_id, seq, text, x0, y0 + 600 AS y0, x1, y1 + 600 AS y1, regexp_extract(trim(text), '^\\**[\t\n\f\r\v ]*([0-9]{{1,2}})[\t\n\f\r\v ]*\\**$', 1) AS no FROM boxed),
p AS (SELECT *, coalesce(no <> '' AND y0 >= 900 AND x0 <= lead(x0) OVER w AND abs(lead(y0) OVER w - y0) <= 40 AND regexp_matches(lead(text) OVER w, '^\\**[\t\n\f\r\v ]*[A-ZÄÖÜ„»§]'), false) AS pair,
  lead(text) OVER w AS t2, lead(x0) OVER w AS a2, lead(y0) OVER w AS b2, lead(x1) OVER w AS c2, lead(y1) OVER w AS d2 FROM n WINDOW w AS (PARTITION BY block_id ORDER BY seq)),
q AS (SELECT *, coalesce(lag(pair) OVER (PARTITION BY block_id ORDER BY seq), false) AS gone FROM p)
SELECT block_id, seq, CASE WHEN pair THEN no || ' ' || ltrim(t2) ELSE text END AS text, CASE WHEN pair THEN least(x0, a2) ELSE x0 END AS x0, CASE WHEN pair THEN least(y0, b2) ELSE y0 END AS y0,
  CASE WHEN pair THEN greatest(x1, c2) ELSE x1 END AS x1, CASE WHEN pair THEN greatest(y1, d2) ELSE y1 END AS y1 FROM q WHERE NOT gone""",
)
register("margin_labels_first", lambda s, d: L.margin_labels_first(_boxed(s, d), "block_id").select("block_id", "seq", "ord"))
