"""Sources mixed to target shares of the total size.

Each source gives its share of the total: first complete epochs of all its
documents, then a fraction of one, drawn by weight without replacement after
Efraimidis and Spirakis: documents in the order of exponential keys scaled by
their quality weight, until the token budget is reached. The prefix sums are taken
over buckets of the keys, so only one bucket of a source has to be sorted.

The size of a mix is a choice: the ``FITTING`` total is the greatest for which no
source falls short of its share, so all shares are met; the ``HELD`` total is what the
sources hold once, and sources that cannot be repeated often enough fall short of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blattwerk.llm.sizes import TOKENIZER, token_sizes
from blattwerk.plans import broadcast_if_small, cut

#: Buckets of the keys of one source.
BUCKETS = 4_096
SEED = 20_240_229
#: Totals of a mix that depend on what its sources hold.
FITTING, HELD = "fitting", "held"


def source_budgets(sizes: DataFrame, targets: DataFrame, total_tokens: int | str = FITTING) -> DataFrame:
    """``mix_name, source, target_share, max_repeats, available, take, epochs, rest, capped`` of each target.

    ``total_tokens`` is the size of each mix, a number or ``FITTING`` or ``HELD``. ``take`` is the share of it, at
    most ``max_repeats`` times what the source holds. Sources that hold nothing or may not be used have no say in
    the fitting total; the others keep their proportions.
    """
    held = sizes.groupBy("source").agg(F.sum("tokens").alias("available"))
    wanted = (
        targets.where("mix_name IS NOT NULL AND target_share > 0")
        .groupBy("mix_name", F.coalesce(F.lower(F.trim("source")), F.lit("")).alias("source"))
        .agg(F.sum("target_share").alias("target_share"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))).alias("max_repeats"))
    )
    known = wanted.join(held, "source", "left").withColumn("available", F.coalesce("available", F.lit(0).cast("bigint")))
    most = F.col("available") * F.col("max_repeats")
    of_mix = Window.partitionBy("mix_name")
    if total_tokens == FITTING:
        total = F.coalesce(F.min(F.when(most > 0, most / F.col("target_share"))).over(of_mix), F.lit(0.0))
    elif total_tokens == HELD:
        total = F.sum("available").over(of_mix).cast("double")
    else:
        total = F.lit(float(total_tokens))
    want = F.col("target_share") * total
    take = F.least(want, most)
    epochs = F.when(F.col("available") > 0, F.least(F.floor(take / F.col("available")), F.col("max_repeats"))).otherwise(F.lit(0)).cast("int")
    return known.select("mix_name", "source", "target_share", "max_repeats", "available", take.alias("take"), epochs.alias("epochs"), (want > most + 0.5).alias("capped")).withColumn(
        "rest", F.greatest(F.col("take") - F.col("epochs") * F.col("available"), F.lit(0.0))
    )


def mix(sizes: DataFrame, targets: DataFrame, total_tokens: int | str = FITTING, seed: int = SEED) -> DataFrame:
    """``mix_name, source, doc_id, copies, tokens`` of the documents used, ``tokens`` those of one copy.

    ``sizes`` (``doc_id, source, tokens, weight``; cut beforehand) may hold repeated rows, which are
    documents of their own; documents without tokens or of sources in no mix are not used.
    An empty table of documents or targets gives an empty mix.
    """
    budgets = cut(source_budgets(sizes, targets, total_tokens))
    wanted = broadcast_if_small(budgets.where("epochs > 0 OR rest > 0").select("mix_name", "source", "epochs", "rest"))
    u = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = sizes.where("tokens > 0").select("doc_id", "source", "tokens", (-F.ln(u) / F.greatest("weight", F.lit(1e-6))).alias("key"))
    keyed = keyed.withColumn("bucket", F.least(F.floor((1 - F.exp(-F.col("key"))) * BUCKETS), F.lit(BUCKETS - 1)).cast("int"))
    # a document that is longer than the whole budget has no place in the draw
    each = keyed.join(wanted, "source").withColumn("fits", F.col("tokens") <= F.col("rest"))
    sums = each.where("fits").groupBy("mix_name", "source", "bucket", "rest").agg(F.sum("tokens").alias("in_bucket"))
    before = F.sum("in_bucket").over(Window.partitionBy("mix_name", "source").orderBy("bucket")) - F.col("in_bucket")
    # at most BUCKETS rows a source and mix
    edges = sums.withColumn("before", before).where(F.col("before") < F.col("rest")).select("mix_name", "source", "bucket", "before", (F.col("before") + F.col("in_bucket") <= F.col("rest")).alias("whole"))
    placed = each.join(broadcast_if_small(cut(edges)), ["mix_name", "source", "bucket"], "left")
    on_edge = F.col("fits") & F.coalesce(~F.col("whole"), F.lit(False))
    inner = placed.where(~on_edge).withColumn("drawn", F.col("fits") & F.coalesce("whole", F.lit(False)))
    edge = placed.where(on_edge)
    run = Window.partitionBy("mix_name", "source", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    # a document belongs to the draw if more than half of it lies within the budget
    edge = edge.withColumn("drawn", F.col("before") + F.sum("tokens").over(run) - F.col("tokens") / 2 <= F.col("rest"))
    both = inner.unionByName(edge).withColumn("copies", F.col("epochs") + F.col("drawn").cast("int"))
    return both.where("copies > 0").select("mix_name", "source", "doc_id", "copies", "tokens")


def shares(sizes: DataFrame, targets: DataFrame, total_tokens: int | str = FITTING, seed: int = SEED) -> DataFrame:
    """``mix_name, source, target_share, reached_share, tokens, documents, most_copies, capped``."""
    used = mix(sizes, targets, total_tokens, seed).groupBy("mix_name", "source").agg(
        F.sum(F.col("copies") * F.col("tokens")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("copies").alias("most_copies")
    )
    b = source_budgets(sizes, targets, total_tokens).select("mix_name", "source", "target_share", "capped")
    n = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
    rows = b.join(used, ["mix_name", "source"], "left").select("mix_name", "source", "target_share", "capped", n("tokens"), n("documents"), n("most_copies"))
    all_tokens = F.sum("tokens").over(Window.partitionBy("mix_name"))
    return rows.withColumn("reached_share", F.when(all_tokens > 0, F.col("tokens") / all_tokens).otherwise(F.lit(0.0)))


def mix_documents(documents: DataFrame, targets: DataFrame, vocab: DataFrame, tokenizer: str = TOKENIZER, total_tokens: int | str = FITTING) -> DataFrame:
    return mix(cut(token_sizes(documents, tokenizer, vocab)), targets, total_tokens)


def document_shares(documents: DataFrame, targets: DataFrame, vocab: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """:func:`shares` for both totals, which the column ``total`` names."""
    sizes = cut(token_sizes(documents, tokenizer, vocab))
    each = [shares(sizes, targets, t).withColumn("total", F.lit(t)) for t in (FITTING, HELD)]
    return each[0].unionByName(each[1])


def faults(sizes: DataFrame, targets: DataFrame, mixed: DataFrame) -> DataFrame:
    """``mix_name, source, strangers, beyond, uneven`` of each target: documents that are not of the source, that are used more
    often than it allows, and whether a document is used twice or more often than another (complete epochs come first)."""
    own = sizes.where("tokens > 0").groupBy("doc_id", "source").agg(F.count(F.lit(1)).alias("times"))
    wanted = source_budgets(sizes, targets).select("mix_name", "source", "max_repeats")
    used = mixed.groupBy("mix_name", "source", "doc_id").agg(F.max("copies").alias("copies")).join(wanted, ["mix_name", "source"]).join(own, ["doc_id", "source"], "left")
    held = own.groupBy("source").agg(F.count(F.lit(1)).alias("held"))
    g = used.groupBy("mix_name", "source").agg(
        F.count_if(F.col("times").isNull()).alias("strangers"), F.count_if(F.col("copies") > F.col("max_repeats")).alias("beyond"), F.max("copies").alias("most"), F.min("copies").alias("least"), F.count(F.lit(1)).alias("n")
    )
    g = g.join(held, "source", "left").withColumn("uneven", F.col("most") - F.when(F.col("n") < F.col("held"), 0).otherwise(F.col("least")) > 1)
    n = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    return wanted.join(g, ["mix_name", "source"], "left").select("mix_name", "source", n(F.col("strangers")).alias("strangers"), n(F.col("beyond")).alias("beyond"), F.coalesce("uneven", F.lit(False)).alias("uneven"))


def document_faults(documents: DataFrame, targets: DataFrame, vocab: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    sizes = cut(token_sizes(documents, tokenizer, vocab))
    return faults(sizes, targets, cut(mix(sizes, targets)))
