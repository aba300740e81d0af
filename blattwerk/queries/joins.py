"""Queries with joins by nearness, on the boxed lines of pages.

The tables hold no boxes: those of a page are its lines with a number, made wider; frames those with the sign of a section.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blattwerk.operators import joins as J
from blattwerk.operators import sequences as S
from blattwerk.queries.lines import BOXED
from blattwerk.queries.quality import BLOCKS
from blattwerk.queries.registry import register
from blattwerk.sources.pages import blocks, boxed, lines_of


NUMBERED, SECTIONED, BEGINNING = "[0-9]", "§", "^[A-ZÄÖÜ]"


def _texts(s: SparkSession, d: str) -> DataFrame:
    return boxed(lines_of(blocks(s, d))).select("block_id", "seq", "text", "x0", "y0", "x1", "y1")


def _lines(s: SparkSession, d: str) -> DataFrame:
    return _texts(s, d).drop("text")


def _side(s: SparkSession, d: str, right: bool) -> DataFrame:
    return _lines(s, d).where((F.col("x0") >= 500) == right)


def _boxes(s: SparkSession, d: str, of: str = NUMBERED) -> DataFrame:
    r = _texts(s, d).where(F.col("text").rlike(of))
    return r.select("block_id", F.col("seq").alias("box_id"), (F.col("x0") - 20).alias("x0"), (F.col("y0") - 5).alias("y0"), (F.col("x1") + 20).alias("x1"), (F.col("y1") + 30).alias("y1"))


_BOX = "SELECT block_id, seq AS box_id, x0 - 20 AS x0, y0 - 5 AS y0, x1 + 20 AS x1, y1 + 30 AS y1 FROM boxed WHERE regexp_matches(text, '{}')"
_BOXES = BOXED + f", box AS ({_BOX.format(NUMBERED)})"

register(
    "nearest_row",
    lambda s, d: J.nearest(_side(s, d, False).select("block_id", "seq", "y0"), _side(s, d, True), "block_id", "y0", "y0", "seq", 25.0),
    f"""WITH {BOXED}, n AS (SELECT l.block_id, l.seq, l.y0, r.seq AS near_id, abs(r.y0 - l.y0) AS distance FROM boxed l JOIN boxed r USING (block_id) WHERE l.x0 < 500 AND r.x0 >= 500 AND abs(r.y0 - l.y0) <= 25)
SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY block_id, seq ORDER BY distance, near_id) = 1""",
)
register(
    "interval_assign",
    lambda s, d: J.by_interval(_side(s, d, True).select("block_id", "seq", "y0"), _texts(s, d).where(F.col("text").rlike(BEGINNING)).select("block_id", "y0", F.col("seq").alias("row_id")), "block_id", "y0", "y0", "row_id", 3),
    f"""WITH {BOXED}, q AS (SELECT block_id, seq AS row_id, y0 - 3 AS f, coalesce(lead(y0) OVER (PARTITION BY block_id ORDER BY y0, seq) - 3, 1000000) AS t FROM boxed WHERE regexp_matches(text, '{BEGINNING}'))
SELECT b.block_id, b.seq, b.y0, q.row_id FROM (SELECT * FROM boxed WHERE x0 >= 500) b LEFT JOIN q ON b.block_id = q.block_id AND b.y0 >= q.f AND b.y0 < q.t""",
)
register(
    "box_first_match",
    lambda s, d: J.first_box(_lines(s, d), _boxes(s, d), "block_id", "seq", "box_id").select("block_id", "seq", "box_id"),
    f"""WITH {_BOXES}, m AS (SELECT b.block_id, b.seq, min(k.box_id) AS box_id FROM boxed b JOIN box k ON b.block_id = k.block_id AND (b.x0 + b.x1) / 2 BETWEEN k.x0 AND k.x1 AND (b.y0 + b.y1) / 2 BETWEEN k.y0 AND k.y1 GROUP BY ALL)
SELECT b.block_id, b.seq, m.box_id FROM boxed b LEFT JOIN m USING (block_id, seq)""",
)
register(
    "frame_anti",
    lambda s, d: J.outside_frames(_lines(s, d), _boxes(s, d, SECTIONED), "block_id").select("block_id", "seq"),
    f"""WITH {BOXED}, f AS ({_BOX.format(SECTIONED)}) SELECT block_id, seq FROM boxed b WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.block_id = b.block_id AND (b.x0 + b.x1) / 2 BETWEEN f.x0 AND f.x1 AND (b.y0 + b.y1) / 2 BETWEEN f.y0 AND f.y1)""",
)
register(
    "box_line_counts",
    lambda s, d: J.lines_in_boxes(_lines(s, d), _boxes(s, d), "block_id", "box_id"),
    f"""WITH {_BOXES} SELECT k.block_id, k.box_id, count(*) AS lines, count(*) >= 2 AS multiline FROM box k JOIN boxed b ON b.block_id = k.block_id AND (b.x0 + b.x1) / 2 BETWEEN k.x0 AND k.x1 AND (b.y0 + b.y1) / 2 BETWEEN k.y0 AND k.y1 GROUP BY ALL""",
)
register(
    "side_by_side",
    lambda s, d: J.side_by_side(_boxes(s, d), "block_id", "box_id"),
    f"""WITH {_BOXES} SELECT DISTINCT a.block_id FROM box a JOIN box b ON a.block_id = b.block_id AND a.box_id < b.box_id WHERE least(a.y1, b.y1) - greatest(a.y0, b.y0) > 0.4 * least(a.y1 - a.y0, b.y1 - b.y0) AND (a.x1 <= b.x0 + 8 OR b.x1 <= a.x0 + 8)""",
)
register(
    "band_semi",
    lambda s, d: J.band_semi(_lines(s, d), _texts(s, d).where(F.col("text").rlike(NUMBERED)), "block_id", "x0", 3).select("block_id", "seq"),
    f"WITH {BOXED} SELECT a.block_id, a.seq FROM boxed a WHERE EXISTS (SELECT 1 FROM boxed b WHERE b.block_id = a.block_id AND regexp_matches(b.text, '{NUMBERED}') AND abs(a.x0 - b.x0) <= 3)",
)
register(
    "page_asof",
    lambda s, d: J.latest_at_or_before(blocks(s, d).select("block_id", "name", "page_no"), blocks(s, d).where("origin = 'ocr'").select("name", "page_no"), "name", "page_no"),
    f"""WITH {BLOCKS}, k AS (SELECT DISTINCT name, page_no AS k FROM blocks WHERE origin = 'ocr') SELECT b.block_id, b.name, b.page_no, coalesce(max(k.k) FILTER (k.k <= b.page_no), min(k.k)) AS follows FROM blocks b JOIN k USING (name) GROUP BY ALL""",
)
register(
    "scroll_position",
    lambda s, d: J.reading_position(_tops(s, d), "name", "page_no", "top", "height", F.lit(2500)),
    f"""WITH {BLOCKS}, t AS (SELECT name, page_no, length(coalesce(markdown, '')) AS height, coalesce(sum(length(coalesce(markdown, ''))) OVER (PARTITION BY name ORDER BY page_no, block_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS top FROM blocks),
h AS (SELECT * FROM t WHERE top <= 2500 QUALIFY row_number() OVER (PARTITION BY name ORDER BY top DESC, page_no DESC) = 1)
SELECT name, CAST(round(page_no + CASE WHEN height > 0 THEN least(greatest((2500 - top) / height, 0.0), 0.999) ELSE 0.0 END, 6) AS DOUBLE) AS position FROM h""",
)


def _tops(s: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    h = F.char_length(F.coalesce("markdown", F.lit("")))
    w = Window.partitionBy("name").orderBy("page_no", "block_id").rowsBetween(Window.unboundedPreceding, -1)
    return blocks(s, d).select("name", "page_no", h.alias("height"), F.coalesce(F.sum(h).over(w), F.lit(0)).alias("top"))


def _visual(s: SparkSession, d: str) -> DataFrame:
    """Visual lines: the left and the right line of a row keep apart, as their heights differ by a point or two."""
    w = _lines(s, d).withColumn("y", F.col("y0") + F.col("seq") % 2 * 5)
    g = S.anchor_sessions(w, ["block_id"], "y", ["x0", "x1", "seq"], 3.0)
    return g.groupBy("block_id", "session").agg(F.min("x0").alias("x_min"), F.max("x1").alias("x_max"), F.min("y").alias("y_min"), (F.max("y") + 14).alias("y_max"))


register(
    "two_column_verdict",
    lambda s, d: J.two_columns(_visual(s, d), "block_id"),
    # the lines of a row keep apart by five units, those of the next row by twenty, so a visual line is a height
    f"""WITH {BOXED}, v AS (SELECT block_id, min(x0) AS x_min, max(x1) AS x_max, y0 + CASE WHEN x0 >= 500 THEN 5 ELSE 0 END + 7 AS y FROM boxed GROUP BY block_id, y0, x0 >= 500),
v2 AS (SELECT *, CASE WHEN x_max <= 540 THEN 'left' WHEN x_min >= 460 THEN 'right' ELSE 'full' END AS side FROM v),
c AS (SELECT block_id, count(*) AS n, count(*) FILTER (side = 'left') AS l, count(*) FILTER (side = 'right') AS r FROM v2 GROUP BY block_id),
p AS (SELECT a.block_id, a.y, a.x_max, b.x_min, abs(b.y - a.y) AS d FROM v2 a JOIN v2 b USING (block_id) WHERE a.side = 'left' AND b.side = 'right' QUALIFY row_number() OVER (PARTITION BY a.block_id, a.y ORDER BY abs(b.y - a.y), b.y) = 1),
g AS (SELECT block_id, count(*) AS pairs, count(*) FILTER (x_min - x_max BETWEEN 30 AND 150) AS valid, median((x_max + x_min) / 2) FILTER (x_min - x_max BETWEEN 30 AND 150) AS m FROM p WHERE d <= 8 GROUP BY block_id),
t AS (SELECT c.block_id, coalesce(n >= 6 AND l >= 3 AND r >= 3 AND l + r >= 0.4 * n AND coalesce(pairs, 0) >= 5 AND valid >= 0.3 * pairs, false) AS two_columns, m FROM c LEFT JOIN g USING (block_id))
SELECT block_id, two_columns, CASE WHEN two_columns THEN round_even(m, 1) ELSE 500.0 END AS split_x FROM t""",
)
register(
    "bounding_boxes",
    lambda s, d: _lines(s, d).groupBy("block_id").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")),
    f"WITH {BOXED} SELECT block_id, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM boxed GROUP BY block_id",
)
register(
    "box_filters",
    lambda s, d: _boxes(s, d).where("x1 - x0 >= 25 AND y1 - y0 >= 14 AND (x1 - x0) * (y1 - y0) < 750000 AND y1 - y0 < 850 AND x1 - x0 < 920"),
    f"WITH {_BOXES} SELECT * FROM box WHERE x1 - x0 >= 25 AND y1 - y0 >= 14 AND (x1 - x0) * (y1 - y0) < 750000 AND y1 - y0 < 850 AND x1 - x0 < 920",
)
register(
    "area_ratio",
    lambda s, d: _boxes(s, d).groupBy("block_id").agg(F.round(F.least(F.sum(F.abs((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))) / 1000000, F.lit(1.0)), 9).alias("ratio")),
    f"WITH {_BOXES} SELECT block_id, round(least(sum(abs((x1 - x0) * (y1 - y0))) / 1000000, 1.0), 9) AS ratio FROM box GROUP BY block_id",
)
