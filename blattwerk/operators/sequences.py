"""Operators on ordered lines: gaps, sessions, runs, windows of neighbours, folds.

All windows are bounded by one page, so no partition grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blattwerk.functions.text import NO_JOIN
from blattwerk.plans import cut


def pitch(lines: DataFrame, page: str, y: str, order: str, least: int = 0, most: int = 200) -> DataFrame:
    """``page, pitch``: the median distance of successive lines that have a place, without jumps."""
    w = Window.partitionBy(page).orderBy(order)
    d = lines.where(F.col(y).isNotNull()).withColumn("_d", F.lead(y).over(w) - F.col(y)).where((F.col("_d") > least) & (F.col("_d") < most))
    return d.groupBy(page).agg(F.median("_d").alias("pitch"))


def with_pitch(lines: DataFrame, page: str, y: str, order: str, least: int = 0, most: int = 200) -> DataFrame:
    """``lines`` with the ``pitch`` of their page (see :func:`pitch`), without a join."""
    placed = F.col(y).isNotNull()
    x = lines.withColumn("_placed", placed)
    d = F.lead(y).over(Window.partitionBy(page, "_placed").orderBy(order)) - F.col(y)
    x = x.withColumn("_d", F.when(placed & (d > least) & (d < most), d))
    return x.withColumn("pitch", F.median("_d").over(Window.partitionBy(page))).drop("_placed", "_d")


def neighbour_median(lines: DataFrame, page: str, value: str, order: str, reach: int = 8, least: int = 4, out: str = "body") -> DataFrame:
    """``lines`` with the median of ``value`` over the ``reach`` rows before and after, without the row's own;
    null with fewer than ``least`` neighbours."""
    w = Window.partitionBy(page).orderBy(order)
    near = F.concat(F.collect_list(value).over(w.rowsBetween(-reach, -1)), F.collect_list(value).over(w.rowsBetween(1, reach)))
    v = F.array_sort(near)
    n, h = F.size(v), F.floor(F.size(v) / 2).cast("int")
    mid = F.when(n % 2 == 1, F.get(v, h).cast("double")).otherwise((F.get(v, h - 1) + F.get(v, h)) / 2.0)
    return lines.withColumn(out, F.when(n >= least, mid))


def short_lines(lines: DataFrame, page: str, order: str, text: str, reach: int = 15, slack: float = 0.08, block: float = 0.55, ratio: float = 0.95, least: int = 6) -> DataFrame:
    """``lines`` (with ``x0, x1``) with ``block`` (set in full measure) and ``short`` (ends well before the margin).

    The margin is the median of the widest fifth (three at least) of the lines about it that have a place. Lines without
    one, if a page has ``least`` of them, are short against ``ratio`` of their median length. A line before a lower-case
    beginning is not short.
    """
    placed = F.col("x1").isNotNull()
    x = lines.withColumn("_placed", placed)
    near = Window.partitionBy(page, "_placed").orderBy(order).rowsBetween(-reach, reach)
    x = x.withColumns({"_rights": F.sort_array(F.collect_list("x1").over(near)), "_left": F.min("x0").over(near)})
    n = F.size("_rights")
    k = F.least(F.greatest(F.lit(3), F.floor(n / 5).cast("int")), n)
    x = x.withColumn("_margin", F.when(placed, (F.get("_rights", n - F.floor(k / 2).cast("int") - 1) + F.get("_rights", n - F.floor((k + 1) / 2).cast("int"))) / 2.0))
    x = x.withColumn("_width", F.col("_margin") - F.col("_left"))
    full = F.size(F.filter("_rights", lambda r: r >= F.col("_margin") - 0.02 * F.col("_width")))
    x = x.withColumn("block", F.coalesce((F.col("_width") > 0) & (full >= block * n), F.lit(False)))
    chars, others = F.char_length(F.trim(text)), Window.partitionBy(page, "_placed")
    brief = ~placed & (F.count(F.lit(1)).over(others) >= least) & (chars < ratio * F.greatest(F.median(chars).over(others), F.lit(1.0)))
    x = x.withColumn("_short", F.coalesce(F.col("block") & (F.col("x1") < F.col("_margin") - slack * F.col("_width")), F.lit(False)) | F.coalesce(brief, F.lit(False)))
    lower = F.coalesce(F.lead(F.regexp_replace(F.col(text), r"^[*\s]+", "")).over(Window.partitionBy(page).orderBy(order)).rlike(r"^\p{Ll}"), F.lit(False))
    return x.withColumn("short", F.col("_short") & ~lower).drop("_placed", "_rights", "_left", "_margin", "_width", "_short")


def short_texts(lines: DataFrame, page: str, text: str, ratio: float = 0.95, least: int = 6) -> DataFrame:
    """``lines`` with ``short``: shorter than ``ratio`` of the page's median length, on pages of ``least`` lines."""
    w = Window.partitionBy(page)
    n = F.char_length(F.trim(text))
    return lines.withColumn("short", (F.count(F.lit(1)).over(w) >= least) & (n < ratio * F.greatest(F.median(n).over(w), F.lit(1.0))))


def gap_sessions(rows: DataFrame, keys: Sequence[str], order: Sequence[str], gap: Column, out: str = "session") -> DataFrame:
    """``rows`` with the number of the chain each belongs to: a chain ends where ``gap`` (over the row before) is true."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_new", F.coalesce(gap, F.lit(False)).cast("int")).withColumn(out, F.sum("_new").over(w)).drop("_new")


def anchor_sessions(rows: DataFrame, keys: Sequence[str], value: str, item: Sequence[str], tolerance: float, out: str = "session") -> DataFrame:
    """``rows`` with the number of the group each belongs to: a row joins while its value is within
    ``tolerance`` of the group's *first* one, which does not move. A fold over each page's sorted rows."""
    step = F.struct(F.col(value).alias("v"), *[F.col(i) for i in item])
    pages = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(step)).alias("_rows"))
    kind = rows.schema[value].dataType.simpleString()
    fields = ", ".join(f"{i}: {rows.schema[i].dataType.simpleString()}" for i in item)
    start = F.struct(
        F.lit(None).cast(kind).alias("anchor"), F.lit(-1).alias("n"), F.array().cast(f"array<struct<{out}: int, v: {kind}, {fields}>>".replace(": ", ":")).alias("done")
    )

    def join(s: Column, r: Column) -> Column:
        new = s["anchor"].isNull() | (r["v"] - s["anchor"] > tolerance)
        n = F.when(new, s["n"] + 1).otherwise(s["n"])
        return F.struct(
            F.when(new, r["v"]).otherwise(s["anchor"]).alias("anchor"),
            n.alias("n"),
            F.concat(s["done"], F.array(F.struct(n.alias(out), r["v"].alias("v"), *[r[i].alias(i) for i in item]))).alias("done"),
        )

    done = pages.select(*keys, F.explode(F.aggregate("_rows", start, join, lambda s: s["done"])).alias("r"))
    return done.select(*keys, F.col("r.v").alias(value), *[F.col(f"r.{i}").alias(i) for i in item], F.col(f"r.{out}").alias(out))


def islands(rows: DataFrame, keys: Sequence[str], order: str, true: Column) -> DataFrame:
    """``keys, first, last, length`` of each run of successive rows for which ``true`` holds."""
    w = Window.partitionBy(*keys).orderBy(order)
    r = rows.withColumn("_all", F.row_number().over(w)).where(true)
    r = r.withColumn("_island", F.col("_all") - F.row_number().over(w))
    return r.groupBy(*keys, "_island").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("length")).drop("_island")


def longest_run(rows: DataFrame, keys: Sequence[str], order: str, true: Column) -> DataFrame:
    return islands(rows, keys, order, true).groupBy(*keys).agg(F.max("length").alias("longest"))


def trim_repeats(lines: DataFrame, page: str, order: str, key: Column, least: int = 3, keep: int = 2, key_length: int = 8) -> DataFrame:
    """``lines`` without what follows the second of ``least`` or more equal successive lines."""
    w = Window.partitionBy(page).orderBy(order)
    x = lines.withColumn("_key", key)
    long = F.char_length("_key") >= key_length
    x = x.withColumn("_new", F.coalesce(~F.col("_key").eqNullSafe(F.lag("_key").over(w)) | ~long, F.lit(True)).cast("int"))
    x = x.withColumn("_run", F.sum("_new").over(w))
    run = Window.partitionBy(page, "_run")
    x = x.withColumn("_n", F.count(F.lit(1)).over(run)).withColumn("_i", F.row_number().over(run.orderBy(order)))
    return x.where((F.col("_n") < least) | (F.col("_i") <= keep)).drop("_key", "_new", "_run", "_n", "_i")


def opened_rows(lines: DataFrame, page: str, order: str, opens: Column, out: str = "row_no") -> DataFrame:
    """``lines`` with the row each belongs to: a line for which ``opens`` holds begins one; 0 is the preamble."""
    return lines.withColumn(out, F.sum(F.coalesce(opens, F.lit(False)).cast("int")).over(Window.partitionBy(page).orderBy(order)))


def sliding_sum(rows: DataFrame, keys: Sequence[str], order: str, value: str, width: int, out: str = "total") -> DataFrame:
    """``rows`` with the sum of the next ``width`` values, without the windows that the end cuts."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(0, width - 1)
    return rows.withColumn(out, F.sum(value).over(w)).withColumn("_n", F.count(F.lit(1)).over(w)).where(F.col("_n") == width).drop("_n")


def column_gap(lines: DataFrame, page: str) -> DataFrame:
    """``page, position`` of the best gap between the beginnings of lines (``x0, x1``), if a page has one.

    Gaps are ranked by the lines that cross them, then by width; both sides hold a quarter of the lines.
    """
    w = Window.partitionBy(page)
    x = lines.select(page, "x0", "x1", F.count(F.lit(1)).over(w).alias("n"), (F.max("x1").over(w) - F.min("x0").over(w)).alias("width"))
    x = x.where((F.col("n") >= 8) & (F.col("width") > 0)).withColumn("full", (F.col("x1") - F.col("x0")) > 0.6 * F.col("width"))
    starts = x.select(page, "n", "width", "x0").distinct()
    g = starts.withColumn("b", F.lead("x0").over(w.orderBy("x0"))).where("b IS NOT NULL").select(page, "n", "width", (F.col("b") - F.col("x0")).alias("gap"), ((F.col("x0") + F.col("b")) / 2.0).alias("position"))
    pairs = g.join(x.select(page, F.col("x0").alias("a0"), F.col("x1").alias("a1"), "full"), page)
    c = pairs.groupBy(page, "n", "width", "gap", "position").agg(
        F.sum((F.col("a0") < F.col("position")).cast("int")).alias("left"), F.sum((~F.col("full") & (F.col("a0") < F.col("position")) & (F.col("a1") > F.col("position"))).cast("int")).alias("crossings")
    )
    side = F.least("left", F.col("n") - F.col("left")) / F.col("n")
    clean = (F.col("gap") >= 0.08 * F.col("width")) & (F.col("crossings") <= 0.02 * F.col("n"))
    ok = c.where((side >= 0.25) & ((F.col("gap") >= 0.25 * F.col("width")) | clean))
    return ok.groupBy(page).agg(F.max_by("position", F.struct(-F.col("crossings"), "gap", -F.col("position"))).alias("position"))


def backward_jumps(lines: DataFrame, page: str, order: str, y: str, by: int = 50) -> DataFrame:
    """Lines that stand at least ``by`` above the one before: a new column or tile."""
    return lines.withColumn("_last", F.lag(y).over(Window.partitionBy(page).orderBy(order))).where(F.col(y) < F.col("_last") - by).drop("_last")


def running_max(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str = "reached") -> DataFrame:
    """``rows`` with the greatest value so far: progress that never goes back."""
    return rows.withColumn(out, F.max(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def width_clusters(boxes: DataFrame, page: str, tolerance: float = 0.05) -> DataFrame:
    """``page, boxes, clusters, spread, diagram``: kinds of widths (in thousandths), and whether they tell a drawing."""
    w = boxes.select(page, ((F.col("x1") - F.col("x0")) / 1000.0).alias("width"))
    g = w.withColumn("new", (F.col("width") - F.lag("width").over(Window.partitionBy(page).orderBy("width")) > tolerance).cast("int"))
    s = g.groupBy(page).agg(F.count(F.lit(1)).alias("boxes"), (F.coalesce(F.sum("new"), F.lit(0)) + 1).alias("clusters"), F.stddev_pop("width").alias("spread"))
    return s.select(page, "boxes", "clusters", F.round("spread", 9).alias("spread"), ((F.col("boxes") >= 3) & (F.col("clusters") >= 3) & (F.round("spread", 9) >= 0.05)).alias("diagram"))


def edge_ratio(lines: DataFrame, page: str, gutter: Column, width: int = 1000, least: int = 20) -> DataFrame:
    """``page, ratio`` of the lines whose right edge lies about the gutter; null for few lines."""
    at = F.col("x1") / width
    near = at.between(gutter - 0.15, gutter + 0.10).cast("double")
    return lines.groupBy(page).agg(F.when(F.count(F.lit(1)) >= least, F.round(F.avg(near), 9)).alias("ratio"))


def joined_lines(lines: DataFrame, keys: Sequence[str], order: Sequence[str], text: str) -> DataFrame:
    """``keys, text``: the lines of each group as one, words that are parted at line ends joined."""
    w = Window.partitionBy(*keys).orderBy(*order)
    x = lines.withColumn("_t", F.trim(text))
    x = x.withColumn("_on", F.coalesce(parted(F.lag("_t").over(w), F.col("_t")), F.lit(False)))
    x = x.withColumn("_cut", F.coalesce(F.lead("_on").over(w), F.lit(False)))
    body = F.when(F.col("_cut"), F.expr("left(_t, char_length(_t) - 1)")).otherwise(F.col("_t"))
    piece = F.when(F.col("_on"), body).otherwise(F.concat(F.lit(" "), body))
    g = x.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, piece.alias("_p")))).alias("_ps"))
    return g.select(*keys, F.trim(F.regexp_replace(F.array_join(F.transform("_ps", lambda r: r["_p"]), ""), r"\s{2,}", " ")).alias(text))


def parted(before: Column, after: Column) -> Column:
    """Whether a word goes on from one line to the next: a hyphen, and a small letter that begins no conjunction."""
    return before.endswith("-") & after.rlike(r"^\p{Ll}") & ~after.rlike(rf"^(?:{NO_JOIN})\b")


def settled(x: DataFrame, page: str, step: Callable[[DataFrame], DataFrame], rounds: int = 2) -> DataFrame:
    """``x`` with its flag ``begins`` (the rows at which a group begins) settled by ``step``.

    A boundary may depend on where the group before it began. ``step`` gives all flags anew from those that are there; each
    round makes at least the next row of a page right, so it ends. Nearly all pages are settled after ``rounds`` rounds, and
    only those that are not go on, by more rounds at a time.
    """
    done = None
    while True:
        for _ in range(rounds):
            x = step(x.withColumn("_was", F.col("begins")))
        x = cut(x)
        open_ = x.where(~F.col("begins").eqNullSafe(F.col("_was"))).select(page).distinct()
        ready = open_.isEmpty()
        part = (x if ready else x.join(open_, page, "left_anti")).drop("_was")
        done = part if done is None else done.unionByName(part)
        if ready:
            return done
        x, rounds = x.join(open_, page, "left_semi").drop("_was"), min(2 * rounds, 8)
