"""Columns, boxes, tables and reading order of pages.

Positions are whole numbers from 0 to 1000 unless said otherwise. What is a matter of sets and windows is
DataFrame operations; the one choice that hangs on all before it (:func:`distinct_boxes`) is a fold over one page.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from blattwerk.functions import text as T
from blattwerk.operators import joins as J
from blattwerk.operators import outline
from blattwerk.operators import sequences as S
from blattwerk.plans import cut

# A gutter lies in the middle 40 %, is 1.5 % wide (gaps of 1 % do not part it), holds less than 35 %
# of the reference ink (the 60th percentile of the inner 80 %), and the 5 % beside it more.
BAND, LEAST_WIDTH, BRIDGE, TROUGH, FLANK, BESIDE, QUANTILE = (0.30, 0.70), 0.015, 0.01, 0.35, 0.35, 0.05, 0.6


def per_page(rows: DataFrame, page: str, cols: Sequence[str], order: Sequence[str], fold: Callable[[list[dict]], list[tuple]], schema: str) -> DataFrame:
    """``fold`` over the rows of each page, sorted by ``order``; ``schema`` names what it returns after the page."""
    kind = rows.schema[page].dataType.simpleString()
    keys = [F.col(o).alias(f"_o{i}") for i, o in enumerate(order)]
    pages = rows.groupBy(page).agg(F.array_sort(F.collect_list(F.struct(*keys, *cols))).alias("rows"))
    out_schema = f"{page} {kind}, {schema}"
    fields = rows.sparkSession.createDataFrame([], out_schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds: list[DataType] = [f.dataType for f in fields]
        for b in batches:
            done = [fold(rs) for rs in b.column(1).to_pylist()]
            at = pa.array([i for i, ts in enumerate(done) for _ in ts], pa.int32())
            cols_ = list(zip(*(t for ts in done for t in ts), strict=True)) or [()] * (len(kinds) - 1)
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), *(pa.array(list(c), to_arrow_type(k)) for c, k in zip(cols_, kinds[1:], strict=True))], fields.names)

    return pages.mapInArrow(run, out_schema)


# --- columns --------------------------------------------------------------------------


def gutter(profile: DataFrame, page: str, width: int) -> DataFrame:
    """``page, center, wide`` (shares of the width) of the widest trough of an ink profile (``page, x, ink``), if there is one."""
    inner = profile.where((F.col("x") >= int(width * 0.10)) & (F.col("x") < int(width * 0.90)))
    ref = inner.groupBy(page).agg(F.expr(f"percentile(ink, {QUANTILE})").alias("ref")).where("ref > 0")
    p = profile.join(ref, page)
    low = p.where((F.col("x") >= int(width * BAND[0])) & (F.col("x") < int(width * BAND[1])) & (F.col("ink") < F.col("ref") * TROUGH))
    by_x = Window.partitionBy(page).orderBy("x")
    runs = low.withColumn("run", F.sum((F.col("x") - F.lag("x").over(by_x) - 1 > width * BRIDGE).cast("int")).over(by_x))
    runs = runs.groupBy(page, F.coalesce("run", F.lit(0)).alias("run"), "ref").agg(F.min("x").alias("a"), (F.max("x") + 1).alias("b"))
    runs = runs.where((F.col("b") - F.col("a")) / width >= LEAST_WIDTH)
    w = max(1, int(width * BESIDE))
    beside = runs.join(profile, page).groupBy(page, "run", "ref", "a", "b").agg(
        F.median(F.when(F.col("x").between(F.col("a") - w, F.col("a") - 1), F.col("ink"))).alias("l"), F.median(F.when(F.col("x").between(F.col("b"), F.col("b") + w - 1), F.col("ink"))).alias("r")
    )
    ok = beside.where((F.col("l") >= F.col("ref") * FLANK) & (F.col("r") >= F.col("ref") * FLANK))
    best = ok.groupBy(page).agg(F.max_by(F.struct("a", "b"), F.struct(F.col("b") - F.col("a"), -F.col("a"))).alias("t"))
    return best.select(page, (F.floor((F.col("t.a") + F.col("t.b")) / 2) / width).alias("center"), ((F.col("t.b") - F.col("t.a")) / width).alias("wide"))


def single_valley(profile: DataFrame, page: str, width: int, trough: float = 0.25, least: float = 0.010) -> DataFrame:
    """``page, center, wide`` by the older rule: the widest stretch in the middle that holds less than ``trough`` of the
    *median* ink, without bridges and without a look at what is beside it."""
    inner = profile.where((F.col("x") >= int(width * 0.10)) & (F.col("x") < int(width * 0.90)))
    ref = inner.groupBy(page).agg(F.median("ink").alias("ref")).where("ref > 0")
    low = profile.join(ref, page).where((F.col("x") >= int(width * BAND[0])) & (F.col("x") < int(width * BAND[1])) & (F.col("ink") < F.col("ref") * trough))
    place = F.col("x") - F.row_number().over(Window.partitionBy(page).orderBy("x"))
    runs = low.withColumn("_g", place).groupBy(page, "_g").agg(F.min("x").alias("a"), (F.max("x") + 1).alias("b"))
    best = runs.groupBy(page).agg(F.max_by(F.struct("a", "b"), F.struct(F.col("b") - F.col("a"), -F.col("a"))).alias("t")).where((F.col("t.b") - F.col("t.a")) / width >= least)
    return best.select(page, (F.floor((F.col("t.a") + F.col("t.b")) / 2) / width).alias("center"), ((F.col("t.b") - F.col("t.a")) / width).alias("wide"))


def edge_valley(edges: DataFrame, page: str, width: int, window: float = 0.03, ratio: float = 0.4) -> DataFrame:
    """``page, two_columns``: whether sums of ``window`` of a profile (``page, x, edges``, every x) are in the middle fifth
    somewhere less than ``ratio`` of the most in the left two fifths."""
    win = max(1, int(width * window))
    lo, hi = int(width * 0.4), int(width * 0.6) - win + 1
    s = S.sliding_sum(edges, [page], "x", "edges", win)
    x = F.col("x")
    g = s.groupBy(page).agg(F.min(F.when((x >= lo) & (x < hi), F.col("total"))).alias("c"), F.max(F.when(x < lo, F.col("total"))).alias("l"))
    return g.select(page, F.coalesce(F.col("c") / F.greatest("l", F.lit(1)) < ratio, F.lit(False)).alias("two_columns"))


def slanted(segments: DataFrame, page: str, drawing: str, least: float = 10) -> DataFrame:
    """``page, slanted``: drawings with a segment (``x0, y0, x1, y1``) that goes more than ``least`` both ways."""
    diagonal = (F.abs(F.col("x1") - F.col("x0")) > least) & (F.abs(F.col("y1") - F.col("y0")) > least)
    return segments.where(diagonal).groupBy(page).agg(F.countDistinct(drawing).alias("slanted"))


def gridded(rules: DataFrame, page: str) -> DataFrame:
    """``page, grid``: three rules across and one along make a grid (``rules``: ``page, across, at``)."""
    return rules.groupBy(page).agg(((F.count_if(F.col("across")) >= 3) & (F.count_if(~F.col("across")) >= 1)).alias("grid"))


def cells_of_rules(rules: DataFrame, page: str, width: float, height: float, least: tuple[float, float] = (0.08, 0.02)) -> DataFrame:
    """``page, x0, y0, x1, y1``: the boxes between successive rules, if they are ``least`` of the page wide and high."""
    w = Window.partitionBy(page, "across").orderBy("at")
    gaps = rules.select(page, "across", "at", F.lead("at").over(w).alias("to")).where("to IS NOT NULL")
    rows = gaps.where(F.col("across") & (F.col("to") - F.col("at") >= height * least[1])).select(page, F.col("at").alias("y0"), F.col("to").alias("y1"))
    cols = gaps.where(~F.col("across") & (F.col("to") - F.col("at") >= width * least[0])).select(page, F.col("at").alias("x0"), F.col("to").alias("x1"))
    return rows.join(cols, page).select(page, "x0", "y0", "x1", "y1")


def layouts(pages: DataFrame, gutters: DataFrame, ratios: DataFrame, page: str) -> DataFrame:
    """``page, two_columns, gutter``: a gutter counts if 30 % of the lines end at it, or without lines if it is 1 % wide."""
    j = pages.select(page).join(gutters, page, "left").join(ratios, page, "left")
    two = F.col("center").isNotNull() & F.when(F.col("ratio").isNotNull(), F.col("ratio") >= 0.30).otherwise(F.col("wide") >= 0.010)
    return j.select(page, two.alias("two_columns"), F.when(two, F.col("center")).alias("gutter"))


def region_columns(regions: DataFrame, page: str, body: Sequence[str], width: float = 1000.0, least_share: float = 0.25) -> DataFrame:
    """``page, two_columns, gutter`` from the regions of a layout model (``class, x0, x1``).

    The free stretches between regions come from a running maximum of their ends; the widest within the middle
    counts if it is 1.5 % wide and a quarter of the regions lies on each side.
    """
    r = regions.where(F.col("class").isin(*body)).select(page, "x0", "x1")
    w = Window.partitionBy(page)
    r = r.withColumn("span", F.max("x1").over(w) - F.min("x0").over(w)).where((F.col("x1") - F.col("x0") <= 0.6 * F.col("span")) & (F.col("span") > 0))
    mille = lambda c: F.greatest(F.lit(0), F.least(F.lit(1000), (F.col(c) / width * 1000).cast("int")))
    n = r.select(page, "x0", "x1", mille("x0").alias("a"), mille("x1").alias("b"), F.count(F.lit(1)).over(w).alias("n")).where("n >= 2")
    lo, hi = 300, 700
    edge = n.select(page, F.lit(hi).alias("a"), F.lit(hi).alias("b")).distinct()
    u = n.select(page, "a", "b").unionByName(edge)
    end = F.coalesce(F.max("b").over(w.orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(lo))
    g = u.withColumn("f", F.greatest(end, F.lit(lo))).withColumn("t", F.least("a", F.lit(hi))).where("t - f >= 15")
    best = g.groupBy(page).agg(F.max_by(F.struct("f", "t"), F.struct(F.col("t") - F.col("f"), -F.col("f"))).alias("g"))
    mid = best.select(page, F.floor((F.col("g.f") + F.col("g.t")) / 2).alias("mid"))
    pos = F.col("mid") / 1000 * width
    sides = n.join(mid, page).groupBy(page, "mid", "n").agg(F.count_if(F.col("x1") <= pos).alias("l"), F.count_if(F.col("x0") >= pos).alias("r"))
    found = sides.where(F.least("l", "r") / F.col("n") >= least_share).select(page, (F.col("mid") / 1000).alias("gutter"))
    return regions.select(page).distinct().join(found, page, "left").select(page, F.col("gutter").isNotNull().alias("two_columns"), "gutter")


def reading_order(lines: DataFrame, page: str, levels: int = 2) -> DataFrame:
    """``lines`` (``seq, x0, y0, x1``) with ``ord``: full-width lines above the columns, the left column, the right one,
    the other full-width lines; columns are split again up to ``levels`` times.

    Each level adds a letter to a line's path (h, l, r, w), so the order is a sort by path and height.
    """
    x = lines.withColumn("_path", F.lit("")).withColumn("_group", F.concat_ws("|", F.col(page).cast("string"), "_path"))
    for _ in range(levels):
        # a group that has not split stays as it is
        gaps = S.column_gap(x, "_group")
        w = Window.partitionBy("_group")
        y = x.join(gaps, "_group", "left")
        wide = (F.col("x1") - F.col("x0")) > 0.6 * (F.max("x1").over(w) - F.min("x0").over(w))
        y = y.withColumn("_wide", wide & F.col("position").isNotNull())
        top = F.min(F.when(~F.col("_wide"), F.col("y0"))).over(w)
        step = F.when(F.col("position").isNull(), "").when(F.col("_wide"), F.when(F.col("y0") < top, "a").otherwise("d")).when(F.col("x0") < F.col("position"), "b").otherwise("c")
        x = y.withColumn("_path", F.concat("_path", step)).withColumn("_group", F.concat_ws("|", F.col(page).cast("string"), "_path")).drop("position", "_wide")
    order = Window.partitionBy(page).orderBy("_path", "y0", "seq")
    return x.withColumn("ord", F.row_number().over(order)).drop("_path", "_group")


# --- boxes ----------------------------------------------------------------------------


def distinct_boxes(boxes: DataFrame, page: str, close: int = 6) -> DataFrame:
    """``page, x0, y0, x1, y1``: boxes, largest first, without those that nearly equal one that is kept."""

    def fold(rows: list[dict]) -> list[tuple]:
        kept: list[tuple] = []
        for r in rows:
            k = (r["x0"], r["y0"], r["x1"], r["y1"])
            if all(max(abs(a - b) for a, b in zip(k, v, strict=True)) > close for v in kept):
                kept.append(k)
        return kept

    b = boxes.withColumn("_area", -(F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
    return per_page(b, page, ["x0", "y0", "x1", "y1"], ["_area", "x0", "y0"], fold, "x0 int, y0 int, x1 int, y1 int")


def stacked_boxes(boxes: DataFrame, page: str, across: int = 4, gap: int = 5) -> DataFrame:
    """``page, x0, y0, x1, y1``: boxes of the width of the first one that follow on one another made one."""
    w = Window.partitionBy(page).orderBy("x0", "x1", "y0", "y1", "_row")
    x = boxes.select(page, "x0", "y0", "x1", "y1", F.monotonically_increasing_id().alias("_row"))
    x = cut(x.withColumn("begins", F.lag("x0").over(w).isNull()))

    def step(y: DataFrame) -> DataFrame:
        y = y.withColumn("_g", F.sum(F.col("begins").cast("int")).over(w))
        y = y.withColumn("_f", F.struct(F.first("x0").over(w.partitionBy(page, "_g")).alias("x0"), F.first("x1").over(w.partitionBy(page, "_g")).alias("x1"), F.max("y1").over(w.partitionBy(page, "_g")).alias("y1")))
        before = F.lag("_f").over(w)
        fits = (F.abs(before["x0"] - F.col("x0")) <= across) & (F.abs(before["x1"] - F.col("x1")) <= across) & (F.col("y0") - before["y1"] <= gap)
        return y.withColumn("begins", ~F.coalesce(fits, F.lit(False))).drop("_g", "_f")

    done = S.settled(x, page, step).withColumn("_g", F.sum(F.col("begins").cast("int")).over(w))
    first = lambda c: F.min_by(c, F.struct("x0", "x1", "y0", "y1", "_row")).alias(c)
    return done.groupBy(page, "_g").agg(first("x0"), F.min("y0").alias("y0"), first("x1"), F.max("y1").alias("y1")).drop("_g")


def detected_boxes(boxes: DataFrame, lines: DataFrame, frames: DataFrame, page: str, slanted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Boxes of two lines or more, and ``page, diagram``.

    Boxes as large as the page go, so do those within table frames and those without text. A page is a drawing
    if its boxes differ in width, if two stand side by side, or if it has two slanted lines (``page, slanted``).
    """
    b = boxes.where("(x1 - x0) * (y1 - y0) < 750000 AND y1 - y0 < 850 AND x1 - x0 < 920")
    b = J.outside_frames(b, frames, page).withColumn("box_id", F.row_number().over(Window.partitionBy(page).orderBy("y0", "x0", "y1", "x1")))
    held = J.lines_in_boxes(lines, b, page, "box_id")
    b = b.join(held, [page, "box_id"])
    multi = b.where("multiline")
    spread = S.width_clusters(b, page).select(page, "diagram")
    beside = J.side_by_side(multi, page, "box_id").withColumn("beside", F.lit(True))
    d = lines.select(page).distinct().join(spread, page, "left").join(beside, page, "left")
    if slanted is not None:
        d = d.join(slanted, page, "left")
    arrows = F.coalesce(F.col("slanted") >= 2, F.lit(False)) if slanted is not None else F.lit(False)
    return multi, d.select(page, (F.coalesce("diagram", F.lit(False)) | F.coalesce("beside", F.lit(False)) | arrows).alias("diagram"))


def box_rows(profile: DataFrame, page: str, length: int, least: float = 0.12, thickness: int = 4) -> DataFrame:
    """``page, at``: the middle of each straight line in a raster, from the longest dark run of each row (``page, y, run``)."""
    rows = profile.where(F.col("run") >= length * least)
    by = Window.partitionBy(page).orderBy("y")
    g = rows.withColumn("g", F.sum((F.col("y") - F.lag("y").over(by) > thickness).cast("int")).over(by))
    return g.groupBy(page, F.coalesce("g", F.lit(0)).alias("g")).agg(F.avg("y").alias("at")).select(page, "at")


def bold_lines(lines: DataFrame, page: str, factor: float = 1.45, widest: float = 0.75, least: int = 5) -> DataFrame:
    """``lines`` (``text, x0, x1, density, height``) with bold marks on those with much more ink than lines of their height.

    The median is that of the height class (five units) if it has three lines, else that of the page.
    """
    w, c = Window.partitionBy(page), Window.partitionBy(page, F.floor(F.col("height") / 5))
    known = F.count("density").over(w) >= least
    mid = F.when(F.count("density").over(c) >= 3, F.median("density").over(c)).otherwise(F.median("density").over(w))
    share = (F.col("x1") - F.col("x0")) / F.greatest(F.max(F.col("x1") - F.col("x0")).over(w), F.lit(1))
    bold = known & (mid > 0) & (F.col("density") > mid * factor) & (share <= widest) & (F.trim("text") != "") & ~F.trim("text").startswith("**")
    return lines.withColumn("text", F.when(F.coalesce(bold, F.lit(False)), F.concat(F.lit("**"), F.trim("text"), F.lit("**"))).otherwise(F.col("text")))


# --- tables ---------------------------------------------------------------------------


def ruled_tables(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, markdown`` of tables of cells (``row, col, text, bold``): two rows and columns at least after blank
    ones went, two rows with two filled cells."""
    c = cells.withColumn("text", T.clean_cell(F.coalesce("text", F.lit("")))).withColumn("full", F.col("text") != "")
    w = Window.partitionBy(*keys)
    c = c.withColumn("row_full", F.max("full").over(w.partitionBy(*keys, "row"))).withColumn("col_full", F.max("full").over(w.partitionBy(*keys, "col"))).where("row_full AND col_full")
    shown = F.when(F.coalesce("bold", F.lit(False)) & F.col("full"), F.concat(F.lit("**"), "text", F.lit("**"))).otherwise(F.col("text"))
    rows = c.groupBy(*keys, "row").agg(F.array_sort(F.collect_list(F.struct("col", shown.alias("t")))).alias("cs"), F.count_if("full").alias("filled"))
    t = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("row", "cs"))).alias("rs"), F.count_if(F.col("filled") >= 2).alias("good"), F.max(F.size("cs")).alias("width"))
    t = t.where((F.size("rs") >= 2) & (F.col("width") >= 2) & (F.col("good") >= 2))
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r["cs"], lambda x: x["t"]), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.array_join(F.array_repeat(F.lit(" --- "), F.col("width")), "|"), F.lit("|"))
    body = F.transform(F.slice("rs", F.lit(2), F.size("rs") - 1), line)
    return t.select(*keys, F.array_join(F.concat(F.array(line(F.get(F.col("rs"), F.lit(0))), rule), body), "\n").alias("markdown"))


def answer_tables(lines: DataFrame, page: str, tolerance: int = 3) -> DataFrame:
    """``page, part, text`` of pages whose right column (``side`` l or r) answers the left one, as tables.

    A left line that begins a thought opens a row; right lines belong to the row whose interval of heights holds
    them. Six lines a side, four beginnings, and three blocks of the right side (three of four of all) that begin
    beside one are asked for; other pages come out with no row. A bold line alone without an answer is a heading
    between tables.
    """
    x = lines.select(page, "seq", "side", "text", "y0", "y1").withColumn("start", (F.col("side") == "l") & outline.line_start(F.col("text")))
    side = Window.partitionBy(page, "side").orderBy("y0", "seq")
    whole = Window.partitionBy(page)
    right = F.col("side") == "r"
    tall = F.when(F.median(F.when(right, F.col("y1") - F.col("y0"))).over(whole) > 0, F.median(F.when(right, F.col("y1") - F.col("y0"))).over(whole)).otherwise(F.lit(10.0))
    x = x.withColumn("_above", F.lag("y1").over(side)).withColumn("_first", right & (F.col("_above").isNull() | (F.col("y0") - F.col("_above") > 0.8 * tall)))
    # the nearest beginnings above and below each line
    start = F.when(F.col("start"), F.col("y0"))
    up = Window.partitionBy(page).orderBy("y0").rangeBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(page).orderBy("y0").rangeBetween(0, Window.unboundedFollowing)
    near = F.least(F.col("y0") - F.max(start).over(up), F.min(start).over(down) - F.col("y0")) <= tolerance
    x = x.withColumn("_beside", F.col("_first") & F.coalesce(near, F.lit(False)))
    n = lambda c: F.count_if(c).over(whole)
    x = x.withColumn("_blocks", n(F.col("_first")))
    enough = (n(F.col("side") == "l") >= 6) & (n(right) >= 6) & (n(F.col("start")) >= 4) & (n(F.col("_beside")) >= 3) & (n(F.col("_beside")) >= 0.75 * F.col("_blocks"))
    x = x.withColumn("_ok", enough).where("_ok")
    left = x.where("side = 'l'").withColumn("row_no", F.sum(F.col("start").cast("int")).over(side))
    bounds = left.where("start").select(page, "row_no", "y0")
    answers = J.by_interval(x.where(right), bounds, page, "y0", "y0", "row_no", tolerance).withColumn("row_no", F.coalesce("row_no", F.lit(0)))
    cells = left.unionByName(answers, allowMissingColumns=True)
    # what stands above the first row: each line by itself, the left ones first
    above = cells.where("row_no = 0").select(page, F.lit(0).alias("block"), "side", "y0", "seq", "text")
    held = cells.where("row_no > 0")
    joined = S.joined_lines(held, [page, "row_no", "side"], ["y0", "seq"], "text").withColumn("text", F.replace("text", F.lit("|"), F.lit("\\|")))
    facts = held.groupBy(page, "row_no").agg(
        F.count_if(F.col("side") == "l").alias("asked_in"),
        F.count_if(right).alias("answers"),
        F.min_by("text", F.when(F.col("side") == "l", F.struct("y0", "seq"))).alias("opening"),
        F.max_by("text", F.when(F.col("side") == "l", F.struct("y0", "seq"))).alias("closing"),
    )
    pair = joined.groupBy(page, "row_no").agg(*[F.coalesce(F.max(F.when(F.col("side") == s, F.col("text"))), F.lit("")).alias(s) for s in "lr"])
    rows = facts.join(pair, [page, "row_no"])
    rows = rows.withColumn("head", (F.col("answers") == 0) & (F.col("asked_in") == 1) & F.col("opening").startswith("**"))
    by_row = Window.partitionBy(page).orderBy("row_no")
    question = F.count_if(F.rtrim("closing").endswith("?")).over(whole) * 2 >= F.count(F.lit(1)).over(whole)
    # headings part tables: a block is a heading or the rows up to the next one
    rows = rows.withColumn("_asked", question).withColumn("_new", F.col("head") | F.coalesce(F.lag("head").over(by_row), F.lit(True)))
    rows = rows.withColumn("block", F.sum(F.col("_new").cast("int")).over(by_row))
    line = F.concat(F.lit("| "), "l", F.lit(" | "), "r", F.lit(" |"))
    tables = rows.groupBy(page, "block", "head", "_asked").agg(F.min("l").alias("l"), F.array_sort(F.collect_list(F.struct("row_no", line.alias("t")))).alias("ts"))
    top = F.when(F.col("_asked"), "| Frage | Antwort |").otherwise("|  |  |")
    table = F.concat_ws("\n", top, F.lit("| --- | --- |"), F.array_join(F.transform("ts", lambda t: t["t"]), "\n"))
    made = tables.select(page, "block", F.lit("").alias("side"), F.lit(0).alias("y0"), F.lit(0).alias("seq"), F.when(F.col("head"), F.col("l")).otherwise(table).alias("text"))
    order = Window.partitionBy(page).orderBy("block", "side", "y0", "seq")
    return above.unionByName(made).select(page, (F.row_number().over(order) - 1).alias("part"), "text")


# --- lines of a text layer ----------------------------------------------------------------

# The bit of a span's flags that says bold, and the marker of a line that is a whole table.
BOLD_FLAG, TABLE = 16, "tabelle"


def text_lines(spans: DataFrame, page: str, tables: DataFrame | None = None, width: float = 595.0, height: float = 842.0) -> DataFrame:
    """``page, seq, text, x0, y0, x1, y1, marker`` of the lines of a text layer, places in thousandths.

    ``spans`` has ``line, span, text, font, flags, upright`` and the line's ``x0, y0, x1, y1``; ``tables`` has
    ``markdown`` and the same four. Tables come first (marker ``TABLE``), lines whose centre lies in one go, lines that run
    upright come last. Bold spans are marked, a lone o of a typewriter font is a list mark; lines without text go.
    """
    t, font = T.clean_line(F.col("text")), F.lower(F.coalesce("font", F.lit("")))
    bold = (F.coalesce("flags", F.lit(0)).bitwiseAND(BOLD_FLAG) != 0) | font.contains("bold")
    shown = F.concat(F.regexp_extract("t", r"^(\s*)", 1), F.lit("**"), F.trim("t"), F.lit("**"), F.regexp_extract("t", r"(\s*)$", 1))
    piece = F.when(F.trim("t") == "", F.col("t")).when(F.trim("t").isin("o", "O") & font.contains("courier"), "-").when(bold, shown).otherwise(F.col("t"))
    box = ["x0", "y0", "x1", "y1"]
    s = spans.where("text IS NOT NULL").withColumn("t", t).withColumn("piece", piece)
    g = s.groupBy(page, "line").agg(F.array_sort(F.collect_list(F.struct("span", "piece"))).alias("ps"), *[F.min(c).cast("double").alias(c) for c in box], F.max(F.coalesce("upright", F.lit(False))).alias("upright"))
    lines = g.select(page, F.col("line").alias("seq"), F.trim(F.array_join(F.transform("ps", lambda p: p["piece"]), "")).alias("text"), *box, "upright").where("text <> ''")
    if tables is not None:
        lines = J.outside_frames(lines, tables, page)
    per_mille = [(F.col(c) / of * 1000).cast("int").alias(c) for c, of in zip(box, (width, height, width, height), strict=True)]
    flat = joined_fragments(lines.where("NOT upright"), page, width).select(page, F.lit(1).alias("k"), F.col("i").alias("at"), "text", *per_mille, F.lit(None).cast("string").alias("marker"))
    rows = flat.unionByName(lines.where("upright").select(page, F.lit(2).alias("k"), F.col("seq").cast("int").alias("at"), "text", *per_mille, F.lit(None).cast("string").alias("marker")))
    if tables is not None:
        order = Window.partitionBy(page).orderBy("y0", "x0")
        rows = rows.unionByName(tables.select(page, F.lit(0).alias("k"), F.row_number().over(order).alias("at"), F.col("markdown").alias("text"), *per_mille, F.lit(TABLE).alias("marker")))
    return rows.select(page, (F.row_number().over(Window.partitionBy(page).orderBy("k", "at")) - 1).alias("seq"), "text", *box, "marker")


# --- lines that move ------------------------------------------------------------------

# List marks that stand alone.
ALONE = r"^(?:\*\*)?\s*(?:[-•·▪○●⇒⇨→➢✔o]|\(?\d{1,2}[.)]|\(?[a-z]{1,3}\)|[IVXL]{1,5}\.)\s*(?:\*\*)?$"
# A number alone, and what the text of a note begins with.
NOTE_NUMBER, NOTE_TEXT = r"^\**\s*(\d{1,2})\s*\**$", r"^\**\s*[A-ZÄÖÜ„»§]"

def joined_fragments(lines: DataFrame, page: str, width: float, gap: float = 0.15, most: float = 60.0) -> DataFrame:
    """``page, i, text, x0, y0, x1, y1``: list marks that stand alone joined with what follows on their baseline.

    Lines that overlap by half the lesser height stand on one baseline, whose hull grows with them. In the order of
    beginnings, the lower end of the hull is the lowest end so far, so only its upper end hangs on where a band began.
    """
    reach = min(gap * width, most)
    down = Window.partitionBy(page).orderBy("y0", "seq")
    x = lines.select(page, "seq", "text", *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")])
    x = x.withColumn("_low", F.max("y1").over(down.rowsBetween(Window.unboundedPreceding, -1))).withColumn("begins", F.col("_low").isNull() | (F.col("_low") <= F.col("y0")))

    def step(b: DataFrame) -> DataFrame:
        b = b.withColumn("_top", F.last(F.when(F.col("begins"), F.col("y0")), ignorenulls=True).over(down))
        lesser = F.least(F.col("_low") - F.lag("_top").over(down), F.col("y1") - F.col("y0"))
        shared = F.least("_low", "y1") - F.col("y0") > 0.5 * F.when(lesser == 0, 1.0).otherwise(lesser)
        return b.withColumn("begins", F.col("_low").isNull() | ~F.coalesce(shared, F.lit(False))).drop("_top")

    x = S.settled(x, page, step).withColumn("_band", F.sum(F.col("begins").cast("int")).over(down))
    across = Window.partitionBy(page, "_band").orderBy("x0", "y0", "seq")
    then = F.struct("text", "x0", "y0", "x1", "y1")
    x = x.withColumn("_next", F.lead(then).over(across))
    room = F.col("_next.x0") - F.col("x1")
    x = x.withColumn("_open", F.coalesce(F.trim("text").rlike(ALONE) & (room >= 0) & (room < reach), F.lit(False)))
    # of marks in a row the first takes the second, the third the fourth
    x = x.withColumn("_run", F.sum((~F.col("_open")).cast("int")).over(across.rowsBetween(Window.unboundedPreceding, -1)))
    x = x.withColumn("_odd", F.row_number().over(Window.partitionBy(page, "_band", F.coalesce("_run", F.lit(0))).orderBy("x0", "y0", "seq")) % 2 == 1)
    x = x.withColumn("_pair", F.col("_open") & F.col("_odd")).withColumn("_gone", F.coalesce(F.lag("_pair").over(across), F.lit(False))).where("NOT _gone")
    joined = F.regexp_replace(F.concat(F.rtrim("text"), F.lit(" "), F.ltrim(F.col("_next.text"))), r"\*\*(\s*)\*\*", "$1")
    pair = lambda a, b: F.when(F.col("_pair"), b).otherwise(a)
    order = Window.partitionBy(page).orderBy("_band", "x0", "y0", "seq")
    return x.select(
        page,
        (F.row_number().over(order) - 1).alias("i"),
        pair(F.col("text"), joined).alias("text"),
        "x0",
        pair(F.col("y0"), F.least("y0", "_next.y0")).alias("y0"),
        pair(F.col("x1"), F.col("_next.x1")).alias("x1"),
        pair(F.col("y1"), F.greatest("y1", "_next.y1")).alias("y1"),
    )


def numbered_notes(lines: DataFrame, page: str, foot: int = 900, near: int = 40) -> DataFrame:
    """``lines`` (``seq, text, x0, y0, x1, y1`` and what else they have) with the numbers of footnotes that stand out on
    the left joined with their text, which stands in the next line."""
    w = Window.partitionBy(page).orderBy("seq")
    x = lines.withColumn("_next", F.lead(F.struct(*lines.columns)).over(w))
    number, then = F.regexp_extract(F.trim("text"), NOTE_NUMBER, 1), F.col("_next")
    pair = (number != "") & (F.col("y0") >= foot) & (F.col("x0") <= then["x0"]) & (F.abs(then["y0"] - F.col("y0")) <= near) & then["text"].rlike(NOTE_TEXT)
    x = x.withColumn("_pair", F.coalesce(pair, F.lit(False)))
    x = x.withColumn("_gone", F.coalesce(F.lag("_pair").over(w), F.lit(False))).where("NOT _gone")
    made = {"text": F.concat(number, F.lit(" "), F.ltrim(then["text"])), **{c: f(c, then[c]) for c, f in (("x0", F.least), ("y0", F.least), ("x1", F.greatest), ("y1", F.greatest))}}
    return x.select(*[F.when(F.col("_pair"), made.get(c, F.col(c) if c in (page, "seq") else then[c])).otherwise(F.col(c)).alias(c) for c in lines.columns])


def margin_labels_first(lines: DataFrame, page: str, out_by: int = 25, reach: int = 8, least: int = 4, gap: float = 1.6) -> DataFrame:
    """``lines`` with ``ord``, in whose order labels in the margin stand before the block they belong to.

    Only pages with a label are looked at further. A label stands ``out_by`` left of the median beginning of the lines about it. The other lines are parted into blocks:
    a list item and a line without a place stand by themselves, and a gap parts. A label goes to the beginning of the
    block that it follows, behind the last line of it that stands out as well.
    """
    w = Window.partitionBy(page).orderBy("seq")
    labelled = F.max(F.coalesce(outline.margin_label(F.col("text")), F.lit(False))).over(Window.partitionBy(page))
    told = lines.withColumn("_labelled", labelled)
    plain = told.where("NOT _labelled").select(*lines.columns, F.row_number().over(w).alias("ord"))
    lines = told.where("_labelled").drop("_labelled")
    return plain.unionByName(_labels_first(lines, page, out_by, reach, least, gap))


def _labels_first(lines: DataFrame, page: str, out_by: int, reach: int, least: int, gap: float) -> DataFrame:
    w = Window.partitionBy(page).orderBy("seq")
    x = S.with_pitch(S.neighbour_median(lines, page, "x0", "seq", reach, least, "_body"), page, "y0", "seq")
    x = x.withColumns({"_at": F.row_number().over(w), "_n": F.count(F.lit(1)).over(Window.partitionBy(page))})
    out = outline.margin_label(F.col("text")) & (F.col("x0") <= F.col("_body") - out_by) & F.col("pitch").isNotNull() & (F.col("_n") >= 4) & (F.col("_at") > 1)
    x = x.withColumn("_out", F.coalesce(out, F.lit(False)))
    lone = ~F.col("_out") & (F.col("x0").isNull() | outline.enumeration(F.col("text")))
    rest = Window.partitionBy(page, "_out").orderBy("seq")
    x = x.withColumn("_lone", F.coalesce(lone, F.lit(False)))
    far = F.lag("y1").over(rest) < F.col("y0") - gap * F.col("pitch")
    opens = ~F.col("_out") & (F.col("_lone") | F.coalesce(F.lag("_lone").over(rest), F.lit(False)) | F.coalesce(far, F.lit(False)))
    x = x.withColumn("_block", F.sum(opens.cast("int")).over(w))
    first = F.min(F.when(~F.col("_out"), F.col("_at"))).over(Window.partitionBy(page, "_block"))
    single = F.max(F.when(~F.col("_out"), F.col("_lone"))).over(Window.partitionBy(page, "_block"))
    x = x.withColumns({"_first": first, "_single": F.coalesce(single, F.lit(True))})
    labels = x.where("_out AND NOT _single AND _first < _at").select(page, "_block", F.col("_at").alias("_label"), (F.col("_body") - out_by).alias("_edge"), "_first")
    own = x.where("NOT _out").select(page, "_block", "_at", "x0")
    behind = labels.join(own, [page, "_block"]).groupBy(page, "_label").agg((F.coalesce(F.max(F.when((F.col("_at") < F.col("_label")) & (F.col("x0") < F.col("_edge")), F.col("_at"))), F.min("_first") - 1) + 1).alias("_target"))
    moved = x.join(behind.withColumnRenamed("_label", "_at"), [page, "_at"], "left")
    place = Window.partitionBy(page).orderBy(F.coalesce("_target", "_at"), F.col("_target").isNull(), "_at")
    return moved.select(*lines.columns, F.row_number().over(place).alias("ord"))


def retried(work: DataFrame, attempt: Callable[[DataFrame, int], DataFrame], failed: Column, key: str, penalty: str, rounds: int = 1) -> DataFrame:
    """The results of ``attempt`` (over rows, round), where failing ones are attempted again and the better result holds.

    Each round works on the failing rows only; ``penalty`` names the column that the better result has less of.
    """
    best = attempt(work, 0)
    for n in range(1, rounds + 1):
        again = attempt(work.join(best.where(failed).select(key), key, "left_semi"), n)
        both = best.withColumn("_round", F.lit(0)).unionByName(again.withColumn("_round", F.lit(n)))
        w = Window.partitionBy(key).orderBy(F.asc_nulls_last(penalty), "_round")
        best = both.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_round")
    return best
