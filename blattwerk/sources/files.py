"""Files beside the pages: catalogues, benchmark rows, word lists, and results that replace others only if they are good."""

from __future__ import annotations

import glob
import os
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blattwerk.sources.parse import dictionary_words

CATALOGUE = "pdf string, page int, chars int, kind string, image string, text string"
BENCHMARK = "run string, model string, pages int, seconds double, seconds_per_page double, tokens bigint, word_accuracy double, citation_accuracy double"
# Names of word lists, those asked for first in front.
WORD_LISTS = ("de_DE*.dic", "de_AT*.dic", "de_CH*.dic", "de*.dic")


def catalogue(spark: SparkSession, path: str, schema: str = CATALOGUE) -> DataFrame:
    """Rows of a catalogue: JSON files that hold an array each; what the schema does not name is passed over."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def benchmark_rows(spark: SparkSession, path: str, schema: str = BENCHMARK) -> DataFrame:
    """Rows of a folder of benchmark files with a head line; a value of the wrong kind is null."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def append_benchmark(rows: DataFrame, path: str) -> None:
    """Adds ``rows`` to the folder, in files of their own with a head line, so runs may append at once."""
    rows.write.mode("append").option("header", True).csv(path)


def write_report(rows: DataFrame, path: str) -> None:
    """``rows`` as JSON lines, nulls included; a report that is there is replaced."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def encoding(aff: str | None) -> str:
    """The character set that the text of an affix file names in one of its first twenty lines; UTF-8 without."""
    for line in (aff or "").splitlines()[:20]:
        m = re.match(r"(?i)SET\s+(\S+)", line)
        if m:
            return {"ISO8859-1": "ISO-8859-1", "ISO8859-15": "ISO-8859-15"}.get(m.group(1).upper(), m.group(1))
    return "UTF-8"


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ``word`` of a word list, read in the character set of the affix file beside it."""
    aff = re.sub(r"\.[^.]*$", ".aff", path)
    head = "\n".join(r["value"] for r in spark.read.text(aff).limit(20).collect()) if os.path.exists(aff) else None
    return dictionary_words(spark.read.option("encoding", encoding(head)).csv(path, sep="\x00", quote="", schema="value string").where("value IS NOT NULL"))


def word_lists(spark: SparkSession, given: Sequence[str] = (), named: str | None = None, places: Sequence[str] = ()) -> DataFrame:
    """Distinct words of the lists ``given`` and ``named`` (paths parted as in the environment), else of the first one that
    stands in ``places``; raises if a list that is named is not there."""
    paths = [*given, *(p for p in (named or "").split(os.pathsep) if p)]
    if not paths:
        paths = next(([sorted(f)[0]] for place in places for pattern in WORD_LISTS if (f := glob.glob(os.path.join(place, pattern)))), [])
    gone = [p for p in paths if not os.path.exists(p)]
    if gone:
        raise FileNotFoundError(f"no such word list: {', '.join(gone)}")
    out = spark.createDataFrame([], "word string")
    for p in paths:
        out = out.unionByName(word_list(spark, p))
    return out.distinct()


def replace_if_good(rows: DataFrame, target: str, good: Callable[[DataFrame], bool]) -> bool:
    """Writes ``rows`` beside ``target`` and puts them in its place if ``good`` (over what was written) says so; else they
    stay beside it, in ``<target>_FAILED``, and ``target`` is as it was. Returns whether they were put in place.

    The folders are renamed, so readers see the old result or the new one; a run that was broken off leaves the old one.
    """
    spark = rows.sparkSession
    fresh, failed, old = f"{target}_NEW", f"{target}_FAILED", f"{target}_OLD"
    rows.write.mode("overwrite").parquet(fresh)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    ok = good(spark.read.parquet(fresh))
    to = target if ok else failed
    fs.delete(path(old), True)
    if fs.exists(path(to)):
        fs.rename(path(to), path(old))
    fs.rename(path(fresh), path(to))
    fs.delete(path(old), True)
    return ok


def lost_letters(before: DataFrame, after: DataFrame, key: str, text: str) -> DataFrame:
    """``key, lost``: share of the letters and digits of each text that the text after it has less of; 1 if it is gone."""
    size = lambda d: F.char_length(F.regexp_replace(F.coalesce(F.col(d), F.lit("")), r"[^\p{L}\p{N}]+", ""))
    b, a = before.select(key, size(text).alias("b")), after.select(key, size(text).alias("a"))
    share = F.when(F.col("b") > 0, F.greatest(F.col("b") - F.coalesce("a", F.lit(0)), F.lit(0)) / F.col("b")).otherwise(F.lit(0.0))
    return b.join(a, key, "left").select(key, share.alias("lost"))
