"""Boundaries at which functions of one's own run: page readers, recognition, spelling checkers.

None of them is part of this package. Each function works on batches, is loaded once a task, and what it
returns is declared, so the rest of a plan stays DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = "path string, page_no int, chars int, width double, height double, image_ratio double, text string"


def files(spark: SparkSession, folder: str, glob: str = "*.pdf") -> DataFrame:
    """``path, length, modificationTime, content`` of the files of a folder; the content is read only if it is used."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)


def page_scan(found: DataFrame, reader: Callable[[str, bytes], Iterable[dict]], schema: str = PAGE, pages: Column | None = None) -> DataFrame:
    """Pages of files by ``reader(path, content)``, which yields a dict a page. ``pages`` (an array of numbers per
    file) is applied to what it yields."""
    kept = found.select("path", "content", (pages if pages is not None else F.lit(None).cast("array<int>")).alias("pages"))
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [{"path": p, **r} for p, c, only in zip(b["path"], b["content"], b["pages"], strict=True) for r in reader(p, bytes(c)) if only is None or r["page_no"] in set(only)]
            yield pd.DataFrame(rows, columns=names)

    return kept.mapInPandas(run, schema)


def recognise(images: DataFrame, load: Callable[[], Callable[[bytes, int], str]], key: str, image: str, budget: str) -> DataFrame:
    """``key, raw``: the output of a model for each image within its token budget. ``load`` is called once a task."""
    kind = images.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for b in batches:
            model = model or load()
            yield pd.DataFrame({key: b[key], "raw": [model(bytes(i), int(n)) for i, n in zip(b[image], b[budget], strict=True)]})

    return images.select(key, image, budget).mapInPandas(run, f"{key} {kind}, raw string")


def checked(words: DataFrame, load: Callable[[], Callable[[list[str]], set[str]]], probe: tuple[list[str], set[str]] = ([], set())) -> DataFrame:
    """``word, unknown``: what an external checker does not know of distinct words. A checker that fails its probe
    or raises is not used: its ``unknown`` is null and the caller's own rules decide."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            check = load()
            usable = check(probe[0]) == probe[1]
        except Exception:  # noqa: BLE001 - whatever a foreign checker raises
            usable = False
        for b in batches:
            try:
                out = check(list(b["word"])) if usable else None
            except Exception:  # noqa: BLE001
                usable, out = False, None
            yield pd.DataFrame({"word": b["word"], "unknown": [None if out is None else w in out for w in b["word"]]})

    return words.select("word").distinct().mapInPandas(run, "word string, unknown boolean")


def compare_rules(rows: DataFrame, key: str, old: Column, new: Column) -> DataFrame:
    """``change, n``: what a new rule does to texts against the old one: unchanged, lost letters, other words but no letter
    lost (hyphens resolved), or the same words in another order."""
    words = lambda c: F.array_sort(F.filter(F.split(c, r"\s+"), lambda w: w != ""))
    letters = lambda c: F.regexp_replace(c, r"[\s*#>|-]+", "")
    x = rows.select(key, old.alias("_a"), new.alias("_b")).withColumns({"_la": letters(F.col("_a")), "_lb": letters(F.col("_b"))})
    count = lambda t, c: F.char_length(t) - F.char_length(F.replace(F.col(t), c, F.lit("")))
    less = F.exists(F.array_distinct(F.split("_la", "")), lambda c: (c != "") & (count("_la", c) > count("_lb", c)))
    kind = F.when(F.col("_a").eqNullSafe(F.col("_b")), "unchanged").when(less, "lost").when(words(F.col("_a")) != words(F.col("_b")), "hyphens resolved").otherwise("reordered")
    return x.select(key, kind.alias("change")).groupBy("change").agg(F.count(F.lit(1)).alias("n"))
