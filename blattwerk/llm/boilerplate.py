"""Lines that stand in excess within one source, and blocks without them.

Each line becomes a key that is blind to case, spacing, markup, punctuation,
numbers and misread glyphs. Within-source and outside-source block frequencies of
a key are compared by the log-likelihood ratio (G²), the false-discovery rate is
held by the Benjamini-Hochberg step-up over all (source, line) pairs tested, and
the significant ones must also pass the exact shares of the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blattwerk.llm.textkernel import NUMBER, line_keys, slices, tokens
from blattwerk.plans import broadcast_if_small, cut, spread

#: A case stands in this many blocks and this share of the blocks of its source.
MIN_BLOCKS, MIN_SHARE = 4, 0.2
#: Words of letters that a line must have.
MIN_WORDS = 3
#: False-discovery rate, and the greatest rate that the outside may lend: what many sources share is no less in excess.
FDR, BACKGROUND = 0.05, 0.02
#: Bins of one unit of ln p for the step-up procedure; beyond the last all p count as equal.
P_BINS = 2_000


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, source = batch.column(0), batch.column(1)
        texts = [x or "" for x in batch.column(2).to_pylist()]
        for a, b in slices(texts):
            t = tokens(texts[a:b], join_hyphens=False)
            words = np.bincount(t.line[t.h != NUMBER], minlength=t.n_lines)[: t.n_lines] + t.line_letters[: t.n_lines]
            key = line_keys(t)
            first = np.searchsorted(t.line_block, np.arange(b - a))
            use = np.flatnonzero((words >= MIN_WORDS) & (key != 0))
            block = t.line_block[use]
            offsets = np.searchsorted(block, np.arange(b - a + 1)).astype(np.int32)
            keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(key[use]))
            numbers = pa.ListArray.from_arrays(pa.array(offsets), pa.array((use - first[block] + 1).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), source.slice(a, b - a), keys, numbers], ["block_id", "source", "keys", "line_nos"])


def block_lines(blocks: DataFrame) -> DataFrame:
    """One row a block: ``block_id, source`` (a hash), ``keys`` and ``line_nos`` of its lines of three words or more."""
    narrow = blocks.where(F.col("source_pdf").isNotNull() & F.col("block_id").isNotNull()).select(
        F.col("block_id").cast("bigint").alias("block_id"), F.xxhash64("source_pdf").alias("source"), F.col("markdown").cast("string").alias("markdown")
    )
    rows = spread(narrow).mapInArrow(_keys, "block_id bigint, source bigint, keys array<bigint>, line_nos array<int>")
    # a block delivered twice has the same content, so any of its rows will do
    return rows.dropDuplicates(["block_id"])


def _g2(k_in: Column, n_in: Column, k_out: Column, n_out: Column) -> Column:
    """G² of a 2x2 table, 0 if the line is not in excess within. With nothing outside, the
    outside rate is taken for one in ``n_in + 1``; it counts as ``BACKGROUND`` if it is greater."""
    some = n_out > 0
    ko, no = F.when(some, F.least(k_out.cast("double"), BACKGROUND * n_out)).otherwise(F.lit(1.0)).cast("double"), F.when(some, n_out).otherwise(n_in + 1).cast("double")
    ki, ni = k_in.cast("double"), n_in.cast("double")
    p, pi, po = (ki + ko) / (ni + no), ki / ni, ko / no

    def part(k: Column, n: Column, own: Column) -> Column:
        gone = F.when(n > k, (n - k) * F.ln((1 - own) / (1 - p))).otherwise(F.lit(0.0))
        return F.when(k > 0, k * F.ln(own / p)).otherwise(F.lit(0.0)) + gone

    return F.when(pi > po, 2 * (part(ki, ni, pi) + part(ko, no, po))).otherwise(F.lit(0.0))


def excess_lines(lines: DataFrame) -> DataFrame:
    """``source, key`` of the lines in significant excess that pass the exact shares.

    ``lines`` is a cut frame of :func:`block_lines`. Pairs are counted with partial
    aggregation, so a source that holds a large share of the blocks is no hot task.
    """
    pairs = lines.select("source", F.explode(F.array_distinct("keys")).alias("key"))
    n_source = lines.groupBy("source").agg(F.count(F.lit(1)).alias("n_in"))
    total = lines.count()
    tested = cut(pairs.groupBy("source", "key").agg(F.count(F.lit(1)).alias("k_in")).where(F.col("k_in") >= MIN_BLOCKS))
    keys = broadcast_if_small(cut(tested.select("key").distinct()))
    k_all = pairs.join(keys, "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("k_all"))
    scored = (
        tested.join(n_source, "source")
        .join(k_all, "key")
        .withColumn("g2", _g2(F.col("k_in"), F.col("n_in"), F.col("k_all") - F.col("k_in"), F.lit(total) - F.col("n_in")))
        # ln of the upper tail of chi-square with one degree of freedom, by Mills' ratio (an upper bound)
        .withColumn("ln_p", F.when(F.col("g2") > 1, -F.col("g2") / 2 - 0.5 * F.ln(F.col("g2") * np.pi / 2)).otherwise(F.lit(0.0)))
        .withColumn("bin", F.least(F.floor(-F.col("ln_p")), F.lit(P_BINS)))
    )
    scored = cut(scored.select("source", "key", "k_in", "n_in", "bin"))
    worst = _step_up({r["bin"]: r["n"] for r in scored.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect()})
    return scored.where((F.col("bin") >= worst) & (F.col("k_in") >= MIN_SHARE * F.col("n_in"))).select("source", "key")


def _step_up(bins: dict[int, int]) -> int:
    """Least bin of -ln p that Benjamini-Hochberg accepts, each p rounded up to its bin."""
    m, rank, worst = sum(bins.values()), 0, P_BINS + 1
    for b in sorted(bins, reverse=True):
        rank += bins[b]
        if -b <= np.log(FDR * rank / m):
            worst = b
    return worst


def source_lines(blocks: DataFrame) -> DataFrame:
    """``block_id, line_no`` of each occurrence of a line that its source repeats in excess.

    Blocks with a null id or a null ``source_pdf`` are left out; null or empty ``markdown``
    counts as a block without lines; repeated rows of a block count once; an empty table
    gives an empty result. Columns other than ``block_id, source_pdf, markdown`` are ignored.
    """
    lines = cut(block_lines(blocks))
    found = broadcast_if_small(cut(excess_lines(lines)))
    rows = lines.select("block_id", "source", F.explode(F.arrays_zip("keys", "line_nos")).alias("x"))
    rows = rows.select("block_id", "source", F.col("x.keys").alias("key"), F.col("x.line_nos").alias("line_no"))
    return rows.join(found, ["source", "key"], "left_semi").select("block_id", "line_no")


def _all_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [x or "" for x in batch.column(2).to_pylist()]
        for a, b in slices(texts):
            t = tokens(texts[a:b], join_hyphens=False)
            words = np.bincount(t.line[t.h != NUMBER], minlength=t.n_lines)[: t.n_lines] + t.line_letters[: t.n_lines]
            keys = np.where(words >= MIN_WORDS, line_keys(t), 0)
            offsets = np.searchsorted(t.line_block, np.arange(b - a + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys))
            yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(3)), lists], ["block_id", "source", "markdown", "keys"])


def without_source_lines(blocks: DataFrame) -> DataFrame:
    """``block_id, markdown, removed``: each block (once) without the lines of :func:`source_lines`.

    Lines are anti-joined with the significant ones of their source, and what is left is put together by position.
    A null ``markdown`` stays null; blocks without source come out as they are.
    """
    found = broadcast_if_small(cut(excess_lines(cut(block_lines(blocks)))))
    narrow = blocks.where(F.col("block_id").isNotNull()).select(
        F.col("block_id").cast("bigint").alias("block_id"), F.when(F.col("source_pdf").isNotNull(), F.xxhash64("source_pdf")).alias("source"), F.col("markdown").cast("string").alias("markdown")
    )
    keyed = spread(narrow).mapInArrow(_all_keys, "block_id bigint, source bigint, markdown string, keys array<bigint>")
    line = F.struct(F.col("n").alias("line_no"), F.col("line"))
    # each block has a line 0 of its own that no join takes: it holds whether there is a text, and how many lines
    zero = F.array(F.struct(F.when(F.col("markdown").isNotNull(), F.size("keys").cast("string")).alias("line"), F.lit(0).cast("bigint").alias("key")))
    own = F.when(F.col("markdown").isNotNull(), F.arrays_zip(F.split("markdown", "\n", -1).alias("line"), F.col("keys").alias("key")))
    lines = keyed.select("block_id", "source", F.posexplode(F.concat(zero, F.coalesce(own, F.slice(zero, 1, 0)))).alias("n", "x")).select("block_id", "source", "n", "x.line", "x.key")
    kept = lines.join(found, ["source", "key"], "left_anti")
    # a block that was delivered twice has the same lines twice
    one = kept.groupBy("block_id").agg(F.array_sort(F.collect_set(line)).alias("ls"))
    head, rest = F.get("ls", F.lit(0))["line"], F.slice("ls", F.lit(2), F.greatest(F.size("ls") - 1, F.lit(0)))
    return one.select(
        "block_id",
        F.when(head.isNotNull(), F.array_join(F.transform(rest, lambda x: x["line"]), "\n")).alias("markdown"),
        F.coalesce(head.cast("int") - F.size(rest), F.lit(0)).alias("removed"),
    )
