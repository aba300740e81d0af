"""Views of the page tables: blocks delivered once, and their lines.

A block that was delivered twice has the same content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blattwerk.plans import broadcast_if_small, cut, spread
from blattwerk.sources.tables import table

#: Units of a page's width and height.
PAGE = 1000


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page block once: the row that was loaded first.

    Which blocks came more than once is found from ids and times alone. They are few, so their list is
    broadcast (after it was counted) and the texts of all others are not shuffled; a list beyond the bound
    is joined by shuffle. Of rows that are alike in their time as well only those are shuffled.
    """
    return once(spread(table(spark, sf_dir, "page_block")), "block_id", "loaded_at")


def once(rows: DataFrame, key: str, at: str) -> DataFrame:
    """``rows`` with each key once, its earliest row; rows without a key stay."""
    times = rows.where(F.col(key).isNotNull()).groupBy(key, at).agg(F.count(F.lit(1)).alias("n"))
    many = cut(times.groupBy(key).agg(F.sum("n").alias("n"), F.min(F.struct(at, "n")).alias("first")).where("n > 1").select(key, F.col(f"first.{at}").alias("_first"), (F.col("first.n") > 1).alias("_alike")))
    met = rows.join(broadcast_if_small(many), key, "left").where(F.col("_alike").isNull() | F.col("_first").eqNullSafe(F.col(at)))
    if many.where("_alike").isEmpty():
        return met.select(*rows.columns)
    alike = F.coalesce("_alike", F.lit(False))
    return met.where(~alike).select(*rows.columns).unionByName(met.where(alike).select(*rows.columns).dropDuplicates([key]))


def lines_of(pages: DataFrame) -> DataFrame:
    """``block_id, name, page_no, origin, seq, text`` of the lines of ``pages``; ``seq`` counts from 0."""
    return pages.where(F.coalesce(F.col("markdown"), F.lit("")) != "").select(
        "block_id", "name", "page_no", "origin", F.posexplode(F.split("markdown", "\n", -1)).alias("seq", "text")
    )


def boxed(lines: DataFrame) -> DataFrame:
    """``lines`` with a box each: a page of two columns, in units of a thousandth, 20 units a row.

    The page tables hold no boxes, so the place follows from ``seq`` and the length of the line.
    """
    row, col = (F.col("seq") / 2).cast("int"), F.col("seq") % 2
    x0 = (80 + 420 * col + (F.col("seq") % 7) * 3).cast("int")
    y0 = (60 + 20 * row).cast("int")
    return lines.where(F.trim("text") != "").withColumns({"x0": x0, "x1": (x0 + F.least(F.lit(400), 4 * F.char_length("text"))).cast("int"), "y0": y0, "y1": (y0 + 14).cast("int")})
