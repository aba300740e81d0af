"""Joins by nearness: as-of, interval, band, spatial.

Each has an equi key first (the page), so Spark hashes or merges by it and the
condition on positions only filters within a page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blattwerk.functions import measures as M


def nearest(left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str, right_id: str, tolerance: float) -> DataFrame:
    """``left`` rows with the nearest right row of the same key within ``tolerance``; the first one of equals."""
    r = right.select(F.col(key), F.col(right_at).alias("_at"), F.col(right_id).alias("_id"))
    l = left.withColumn("_row", F.monotonically_increasing_id()) if "_row" not in left.columns else left  # noqa: E741
    d = F.abs(F.col("_at") - F.col(left_at))
    near = l.join(r, key).where(d <= tolerance)
    cols = [F.first(c).alias(c) for c in left.columns if c not in (key, "_row")]
    return near.groupBy(key, "_row").agg(*cols, F.min_by(F.struct(F.col("_id").alias("id"), d.alias("d")), F.struct(d, F.col("_id"))).alias("_m")).select(
        *left.columns, F.col("_m.id").alias("near_id"), F.col("_m.d").alias("distance")
    )


def by_interval(points: DataFrame, bounds: DataFrame, key: str, at: str, bound: str, bound_id: str, tolerance: float = 0) -> DataFrame:
    """``points`` with the last bound at or before each (less ``tolerance``): half-open intervals.

    One sort of the union by key and position; no pairs are formed. Points before the first bound get null.
    """
    cols = points.columns
    p = points.select(F.col(key), F.col(at).cast("double").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(bounds.schema[bound_id].dataType).alias("_bound"), F.struct(*cols).alias("_row"))
    b = bounds.select(F.col(key), (F.col(bound) - tolerance).cast("double").alias("_at"), F.lit(0).alias("_kind"), F.col(bound_id).alias("_bound"), F.lit(None).cast(p.schema["_row"].dataType).alias("_row"))
    w = Window.partitionBy(key).orderBy("_at", "_kind", "_bound").rowsBetween(Window.unboundedPreceding, 0)
    u = p.unionByName(b).withColumn("_last", F.last("_bound", ignorenulls=True).over(w)).where("_kind = 1")
    return u.select("_row.*", F.col("_last").alias(bound_id))


def first_box(lines: DataFrame, boxes: DataFrame, page: str, line_id: str, box_id: str) -> DataFrame:
    """``lines`` with the first box (by id) that holds the line's centre; null if none does."""
    b = boxes.select(page, F.struct(box_id, "x0", "y0", "x1", "y1").alias("_b")).groupBy(page).agg(F.array_sort(F.collect_list("_b")).alias("_boxes"))
    mx, my = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    hit = F.filter("_boxes", lambda k: mx.between(k["x0"], k["x1"]) & my.between(k["y0"], k["y1"]))
    return lines.join(b, page, "left").select(*lines.columns, F.get(hit, F.lit(0))[box_id].alias(box_id))


def outside_frames(lines: DataFrame, frames: DataFrame, page: str) -> DataFrame:
    """Lines whose centre lies in no frame of their page."""
    f = frames.select(F.col(page).alias("_p"), *[F.col(c).alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")])
    mx, my = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    return lines.join(f, (lines[page] == f["_p"]) & mx.between(F.col("_x0"), F.col("_x1")) & my.between(F.col("_y0"), F.col("_y1")), "left_anti")


def lines_in_boxes(lines: DataFrame, boxes: DataFrame, page: str, box_id: str) -> DataFrame:
    """``page, box_id, lines, multiline`` of the boxes that hold the centre of a line."""
    b = boxes.select(F.col(page), F.col(box_id), *[F.col(c).alias(f"b_{c}") for c in ("x0", "y0", "x1", "y1")])
    mx, my = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    j = lines.join(b, page).where(mx.between(F.col("b_x0"), F.col("b_x1")) & my.between(F.col("b_y0"), F.col("b_y1")))
    return j.groupBy(page, box_id).agg(F.count(F.lit(1)).alias("lines")).withColumn("multiline", F.col("lines") >= 2)


def side_by_side(boxes: DataFrame, page: str, box_id: str, margin: int = 8, share: float = 0.4) -> DataFrame:
    """Pages with two boxes at one height that do not overlap across."""
    b = boxes.select(page, F.struct(box_id, "x0", "y0", "x1", "y1").alias("b")).groupBy(page).agg(F.collect_list("b").alias("bs"))

    def beside(p: Column, q: Column) -> Column:
        high = M.overlap(p["y0"], p["y1"], q["y0"], q["y1"]) > share * F.least(p["y1"] - p["y0"], q["y1"] - q["y0"])
        apart = (p["x1"] <= q["x0"] + margin) | (q["x1"] <= p["x0"] + margin)
        return high & apart & (p[box_id] < q[box_id])

    return b.select(page, F.exists("bs", lambda p: F.exists("bs", lambda q: beside(p, q))).alias("beside")).where("beside").select(page)


def band_semi(left: DataFrame, right: DataFrame, key: str, at: str, tolerance: int) -> DataFrame:
    """Left rows with a right row of the same key within ``tolerance``.

    Both sides are put into buckets as wide as the tolerance and joined with the buckets beside: an equi join.
    """
    wide = max(1, tolerance)
    r = right.select(F.col(key).alias("_k"), F.col(at).alias("_at"), F.explode(F.array(*[F.floor(F.col(at) / wide) + i for i in (-1, 0, 1)])).alias("_bucket"))
    on = (left[key] == r["_k"]) & (F.floor(left[at] / wide) == r["_bucket"]) & (F.abs(left[at] - r["_at"]) <= tolerance)
    return left.join(r, on, "left_semi")


def latest_at_or_before(asked: DataFrame, known: DataFrame, key: str, at: str) -> DataFrame:
    """``asked`` with the greatest known position at or before each, else the least known one, as ``follows``; rows of a key
    without any known position go. One sort of the union by key and position, as in :func:`by_interval`."""
    a = asked.select(F.col(key), F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct(*asked.columns).alias("_row"))
    k = known.where(F.col(at).isNotNull()).select(F.col(key), F.col(at).alias("_at"), F.lit(0).alias("_kind"), F.lit(None).cast(a.schema["_row"].dataType).alias("_row")).distinct()
    here = F.when(F.col("_kind") == 0, F.col("_at"))
    so_far = Window.partitionBy(key).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    u = a.unionByName(k).withColumn("follows", F.coalesce(F.last(here, ignorenulls=True).over(so_far), F.min(here).over(Window.partitionBy(key))))
    return u.where((F.col("_kind") == 1) & F.col("follows").isNotNull() & F.col(key).isNotNull()).select("_row.*", "follows")


def reading_position(pages: DataFrame, key: str, page: str, top: str, height: str, scroll: Column) -> DataFrame:
    """``key, position``: the page at a scroll height and how far into it, as one number."""
    p = pages.withColumn("_s", scroll)
    at = p.where(F.col(top) <= F.col("_s"))
    hit = at.groupBy(key).agg(F.max_by(F.struct(page, top, height, "_s"), F.struct(top, page)).alias("h"))
    frac = F.when(F.col(f"h.{height}") > 0, F.least(F.greatest((F.col("h._s") - F.col(f"h.{top}")) / F.col(f"h.{height}"), F.lit(0.0)), F.lit(0.999))).otherwise(F.lit(0.0))
    return hit.select(key, F.round(F.col(f"h.{page}") + frac, 6).alias("position"))


def two_columns(words: DataFrame, page: str, width: float = 1000.0) -> DataFrame:
    """``page, two_columns, split_x``: whether the visual lines (``session, x_min, x_max, y_min, y_max``) of a page
    stand in two columns, judged by the gaps between nearest lines of the two sides.

    Fixed values: 4 % of the width about the middle, three lines a side, 40 % of the lines beside it, gaps of
    3 to 15 %, 8 points of height, five pairs of which 30 % are plausible.
    """
    mid, slack = width / 2, 0.04 * width
    side = F.when(F.col("x_max") <= mid + slack, "left").when(F.col("x_min") >= mid - slack, "right").otherwise("full")
    v = words.withColumn("side", side).withColumn("y", (F.col("y_min") + F.col("y_max")) / 2)
    counts = v.groupBy(page).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("side") == "left").alias("l"), F.count_if(F.col("side") == "right").alias("r"))
    left = v.where("side = 'left'").select(page, F.col("session").alias("i"), F.col("y").alias("ly"), "x_max")
    right = v.where("side = 'right'").select(page, F.col("session").alias("j"), F.col("y").alias("ry"), "x_min")
    d = F.abs(F.col("ry") - F.col("ly"))
    pairs = left.join(right, page).groupBy(page, "i", "x_max").agg(F.min_by(F.struct("ry", "x_min", d.alias("d")), F.struct(d, "j")).alias("b")).where("b.d <= 8.0")
    gap = F.col("b.x_min") - F.col("x_max")
    ok = gap.between(0.03 * width, 0.15 * width)
    g = pairs.groupBy(page).agg(F.count(F.lit(1)).alias("pairs"), F.count_if(ok).alias("valid"), F.median(F.when(ok, (F.col("x_max") + F.col("b.x_min")) / 2)).alias("m"))
    j = counts.join(g, page, "left")
    two = (F.col("n") >= 6) & (F.col("l") >= 3) & (F.col("r") >= 3) & (F.col("l") + F.col("r") >= 0.4 * F.col("n")) & (F.coalesce("pairs", F.lit(0)) >= 5) & (F.col("valid") >= 0.3 * F.col("pairs"))
    two = F.coalesce(two, F.lit(False))
    return j.select(page, two.alias("two_columns"), F.when(two, F.bround("m", 1)).otherwise(F.lit(mid)).alias("split_x"))
