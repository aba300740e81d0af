"""Recognised text against true text: multisets of words and citations, weighted means."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType


@F.pandas_udf(StructType([StructField(n, IntegerType()) for n in ("true_n", "read_n", "common")]))
def _common(true: pd.Series, read: pd.Series) -> pd.DataFrame:
    pairs = [(Counter(a), Counter(b)) for a, b in zip(true, read, strict=True)]
    return pd.DataFrame({"true_n": [a.total() for a, _ in pairs], "read_n": [b.total() for _, b in pairs], "common": [(a & b).total() for a, b in pairs]})


@F.pandas_udf(ArrayType(StructType([StructField("item", StringType()), StructField("n", IntegerType())])))
def _lost(true: pd.Series, read: pd.Series) -> pd.Series:
    return pd.Series([[{"item": i, "n": n} for i, n in (Counter(a) - Counter(b)).items()] for a, b in zip(true, read, strict=True)])


def overlap(pairs: DataFrame, key: str, true_words: Column, read_words: Column) -> DataFrame:
    """``key, true_n, read_n, common``: sizes of two multisets of words and of their intersection.

    Both stand in one row, so they are compared there and nothing is shuffled.
    """
    return pairs.select(key, _common(true_words, read_words).alias("c")).select(key, "c.true_n", "c.read_n", "c.common")


def missing(pairs: DataFrame, key: str, true_items: Column, read_items: Column) -> DataFrame:
    """``key, item, n``: what stands in the true text more often than in the read one."""
    return pairs.select(key, F.explode(_lost(true_items, read_items)).alias("m")).select(key, "m.item", "m.n")


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.sum(value * weight) / F.sum(weight)


def upper_medians(rows: DataFrame, key: str, value: str) -> DataFrame:
    """``key, middle, least, most``: the element in the middle of each group (the upper one of two, not the mean of
    both), from the numbers of equal values, so that no group is gathered."""
    n = rows.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(key)
    c = n.withColumn("upto", F.sum("n").over(w.orderBy(value))).withColumn("all", F.sum("n").over(w))
    return c.groupBy(key).agg(F.min(F.when(F.col("upto") > F.floor(F.col("all") / 2), F.col(value))).alias("middle"), F.min(value).alias("least"), F.max(value).alias("most"))


def order_similarity(pairs: DataFrame, key: str, true_words: str, read_words: str) -> DataFrame:
    """``key, similarity``: ratio of matching runs of words (difflib's, without its junk rule), by Arrow batches."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from difflib import SequenceMatcher

        for b in batches:
            r = [SequenceMatcher(None, list(x), list(y), autojunk=False).ratio() for x, y in zip(b[true_words], b[read_words], strict=True)]
            yield pd.DataFrame({key: b[key], "similarity": r})

    kind = pairs.schema[key].dataType.simpleString()
    return pairs.select(key, true_words, read_words).mapInPandas(run, f"{key} {kind}, similarity double")
