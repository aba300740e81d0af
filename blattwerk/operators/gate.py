"""Gates and verdicts on the text of pages. Everything is per row, without a shuffle, unless it sums up."""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blattwerk.functions import measures as M
from blattwerk.functions import text as T

# The quality gate.
MIN_BYTES, MIN_CHARS, MAX_GARBAGE, MAX_ISOLATED, LEAST_WORDS = 200, 50, 0.40, 0.40, 50
GRAM = 5
_DIGITS = re.compile(r"\d+")


def word_shapes(text: Column) -> dict[str, Column]:
    """Words with letters, and how many are short, of mixed case, or hold digits."""
    w = T.words_with_letters(text)
    return {
        "words": F.size(w),
        "isolated": F.size(F.filter(w, lambda x: F.char_length(x) <= 2)),
        "mixed": T.count_like(w, r"\p{Ll}\p{Lu}"),
        "digit_alpha": T.count_like(w, r"\p{Nd}"),
    }


def garbage_gate(pages: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, words, garbage, isolated_share, passed`` of each page."""
    c = pages.select(F.col(id_col), *[v.alias(k) for k, v in word_shapes(F.col(text_col)).items()])
    n = F.col("words")
    score = F.when(n > 0, F.round((F.col("isolated") + 3 * F.col("mixed") + 2 * F.col("digit_alpha")) / n, 3)).otherwise(0.0)
    alone = F.when(n > 0, F.round(F.col("isolated") / n, 3)).otherwise(0.0)
    ok = (n < LEAST_WORDS) | ((score <= MAX_GARBAGE) & (alone <= MAX_ISOLATED))
    return c.select(id_col, "words", score.alias("garbage"), alone.alias("isolated_share"), ok.alias("passed"))


def bytes_per_page(pages: DataFrame, key: str, text_col: str) -> DataFrame:
    """Bytes (not characters) per page of each document, and whether they reach the floor."""
    per = F.sum(F.octet_length(F.coalesce(F.col(text_col), F.lit("")))).alias("bytes"), F.count(F.lit(1)).alias("pages")
    g = pages.groupBy(key).agg(*per)
    each = F.expr("bytes div pages")
    return g.select(key, "pages", each.alias("bytes_per_page"), (each >= MIN_BYTES).alias("dense"))


def loop_length(text: Column, n: int = GRAM) -> Column:
    """How often the most frequent digit-blind word n-gram stands in a text; 0 for fewer than 2n words.

    Counted text by text in Arrow batches: as higher-order functions over arrays of n-grams it took five
    microseconds an n-gram, ten times as long.
    """

    @F.pandas_udf("int")
    def loop(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> int:
            w = _DIGITS.sub("#", t or "").split()
            return max(Counter(zip(*(w[i:] for i in range(n)), strict=False)).values()) if len(w) >= 2 * n else 0

        return texts.map(one, na_action=None)

    return loop(text)


def page_verdicts(pages: DataFrame, id_col: str, text_col: str, expected: Column) -> DataFrame:
    """``id, loop, chars, expected, verdict, budget, penalty`` of each page."""
    c = pages.select(F.col(id_col), loop_length(F.col(text_col)).alias("loop"), F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("chars"), expected.alias("expected"))
    return c.select(
        "*",
        M.derailment(F.col("loop"), F.col("chars"), F.col("expected")).alias("verdict"),
        M.token_budget(F.col("expected")).alias("budget"),
        F.round(M.penalty(F.col("loop"), F.col("chars"), F.col("expected")), 6).alias("penalty"),
    )


def running_lines(lines: DataFrame, doc: str, page: str, text_col: str, at: Column, least: int = 2) -> DataFrame:
    """Lines in the head or foot zone (``at`` from 0 to 1) on ``least`` distinct pages of a document."""
    t = T.squeeze(F.regexp_replace(F.col(text_col), r"\*", ""))
    zone = (at <= 0.09) | (at >= 0.93)
    c = lines.where(zone).select(F.col(doc), F.col(page), t.alias("line")).where((F.char_length("line") >= 6) & ~F.col("line").rlike(r"^[\d\s\-–—]*$"))
    return c.groupBy(doc, "line").agg(F.countDistinct(page).alias("pages")).where(F.col("pages") >= least)
