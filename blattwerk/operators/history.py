"""Full history of changing entity attributes, each version with its period.

The observations of an entity are gathered into a sorted array of structs and
folded by a higher-order function that appends a version only upon change.
An entity may hold any share of all rows, so the fold works on one (entity,
period) chunk at a time; what a chunk needs to know of its neighbours (the last
state before it, the first change after it) travels in one small row a chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blattwerk.plans import broadcast_if_small, cut
from blattwerk.sources.manifest import STATUS

OPEN_END = "9999-12-31T00:00:00"

#: Rows of an entity in one chunk above which it is parted by the second (a prefix of this length).
DENSE, SECOND = 5_000, 19


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", F.trim(c))


def canonical_status(c: Column) -> Column:
    """Today's name of a status; unknown names stay, blanks become null."""
    names = F.create_map(*[F.lit(x) for pair in STATUS.items() for x in pair])
    s = blank_to_null(c)
    return F.coalesce(F.try_element_at(names, s), s)


def canonical_instant(c: Column) -> Column:
    """Microseconds since 1970 of an ISO instant, as a string; without a zone it is UTC.

    A value that is no instant stays as the string it is.
    """
    s = blank_to_null(c)
    zoned = F.when(s.rlike(r"(Z|[+-]\d\d:?\d\d)$"), s).otherwise(F.concat(s, F.lit("Z")))
    return F.coalesce(F.unix_micros(F.try_to_timestamp(zoned)).cast("string"), s)


def entity_versions(
    observations: DataFrame,
    key: str,
    at: str,
    loaded: str,
    state: Sequence[Column],
    chunk: int = 10,
) -> DataFrame:
    """Versions ``(key, valid_from, valid_to, state)`` of each entity.

    ``at`` is an ISO string that sorts by time, ``state`` the canonical tracked
    values (its struct comes out as column ``state``), ``chunk`` the length of the prefix of ``at`` that
    names a chunk (10: a day); where an entity has more than ``DENSE`` rows in one, it is parted by the second. Of several rows for one (key, at) the one with
    the latest ``loaded`` holds (null loads first), ties go to the greater state.

    Rows with a null key or a null or blank ``at`` have no place in a history and
    are left out. Repeated rows change nothing. An empty table gives an empty
    history. Other columns are ignored, whatever their names.
    """
    rows = observations.select(
        F.col(key).alias("_key"),
        blank_to_null(F.col(at)).alias("_at"),
        F.col(loaded).alias("_loaded"),
        F.struct(*[s.alias(f"s{i}") for i, s in enumerate(state)]).alias("_state"),
    ).where(F.col("_key").isNotNull() & F.col("_at").isNotNull())
    latest = rows.groupBy("_key", "_at").agg(
        F.max(F.struct(F.coalesce(F.col("_loaded").cast("timestamp"), F.timestamp_micros(F.lit(-(2**62)))).alias("l"), F.col("_state"))).alias("w")
    )
    # the nested "previous" of a state is a struct of nullable fields, so states compare null-safe
    step = F.struct(F.col("_at").alias("at"), F.col("w._state").alias("state"))
    at_chunk = F.substring("_at", 1, chunk)
    dense = broadcast_if_small(cut(rows.groupBy("_key", at_chunk.alias("_chunk")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > DENSE).select("_key", "_chunk", F.lit(True).alias("_dense"))))
    placed = latest.withColumn("_chunk", at_chunk).join(dense, ["_key", "_chunk"], "left").withColumn("_chunk", F.when(F.col("_dense"), F.substring("_at", 1, SECOND)).otherwise(F.col("_chunk")))
    chunks = placed.groupBy("_key", "_chunk").agg(F.array_sort(F.collect_list(step)).alias("steps"))

    def append(versions: Column, s: Column) -> Column:
        changed = (F.size(versions) == 0) | ~F.element_at(versions, -1)["state"].eqNullSafe(s["state"])
        return F.when(changed, F.concat(versions, F.array(s))).otherwise(versions)

    folded = chunks.select(
        "_key",
        "_chunk",
        F.aggregate("steps", F.slice("steps", 1, 0), append).alias("runs"),
    )
    by_time = Window.partitionBy("_key").orderBy("_chunk")
    joined = folded.withColumn("before", F.lag(F.element_at("runs", -1)["state"]).over(by_time)).withColumn("chunk_no", F.row_number().over(by_time))
    # the first run of a chunk goes on with the version before it unless the state differs
    own = joined.withColumn(
        "runs",
        F.when(
            (F.col("chunk_no") > 1) & F.col("runs")[0]["state"].eqNullSafe(F.col("before")),
            F.slice("runs", 2, F.size("runs")),
        ).otherwise(F.col("runs")),
    ).where(F.size("runs") > 0)
    after = own.withColumn("next_from", F.lead(F.col("runs")[0]["at"]).over(by_time))
    pieces = after.select("_key", "next_from", "runs", F.posexplode("runs").alias("i", "run"))
    return pieces.select(
        F.col("_key").alias(key),
        F.col("run.at").alias("valid_from"),
        F.coalesce(F.get(F.col("runs"), F.col("i") + 1)["at"], F.col("next_from"), F.lit(OPEN_END)).alias("valid_to"),
        F.col("run.state").alias("state"),
    )


def manifest_versions(manifest: DataFrame) -> DataFrame:
    """Versions of the status entries: ``name, valid_from, valid_to`` and the canonical values."""
    prev = [
        canonical_status(F.col("previous.status")),
        canonical_instant(F.col("previous.decided")),
        canonical_instant(F.col("previous.ocr_date")),
    ]
    previous = F.when(
        F.coalesce(*prev).isNotNull(),
        F.concat_ws("|", *[F.coalesce(p, F.lit("\x00")) for p in prev]),
    )
    v = entity_versions(
        manifest,
        "name",
        "updated",
        "loaded_at",
        [canonical_status(F.col("status")), previous, canonical_instant(F.col("ocr_timestamp")), canonical_instant(F.col("decided"))],
    )
    return v.select(
        "name",
        "valid_from",
        "valid_to",
        F.col("state.s0").alias("status"),
        F.col("state.s1").alias("previous"),
        F.col("state.s2").alias("ocr_timestamp"),
        F.col("state.s3").alias("decided"),
    )
