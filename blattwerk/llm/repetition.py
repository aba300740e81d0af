"""Repetition inside a single text.

Word n-grams of a text, misread glyphs and numbers blinded, are hashed into
features: the bucket of the n-gram and whether it is its first or a later copy
within the text. Two multinomials over these features are counted over the whole
corpus: the *raw* one over all texts, the *trusted target* one over the texts
without any later copy. The log-likelihood ratio of a text's features under the
two, divided by their number, is about -|log share of later copies|: it is near
zero for a text that says everything once and falls with every repetition. One
fixed threshold holds for every text.

Texts are read once: what is kept of each is its features (two bytes an n-gram) and
the exact share of its repeated words. The multinomials and the ratios come from these.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blattwerk.llm.furniture import LineModel, distinct_lines, page_numbers, read_lines, recurring_lines, with_recurring, without_recurring
from blattwerk.llm.furniture import fit_on_lines as fit_on_sample  # the name by which tests put a model of their own
from blattwerk.llm.textkernel import Tokens, slices, tokens
from blattwerk.plans import cut, spread

#: Words of a hashed n-gram; buckets of n-grams. The feature space has twice as many.
GRAM, BUCKETS = 4, 1 << 12
#: Successive words that make a passage, and the share of later copies that makes a case.
PASSAGE, MIN_SHARE = 8, 0.3
#: A tenth of later copies lies below the threshold at every corpus size (see ``threshold``);
#: texts above it are no cases.
LATER_SHARE = 0.1
_STEP = np.int64(0x9E3779B97F4A7C15 - (1 << 64))


def grams(h: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of ``h`` that lie within one text, and the position of each."""
    if len(h) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        g = np.zeros(len(h) - n + 1, np.int64)
        for i in range(n):
            g = (g ^ (g >> 29)) * _STEP + h[i : len(h) - n + 1 + i]
        g ^= g >> 32
    at = np.flatnonzero(text[: len(h) - n + 1] == text[n - 1 :])
    return g[at], at


def later_copies(g: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether each hash stood before in the same text."""
    with np.errstate(over="ignore"):
        k = g ^ (text * _STEP)
    order = np.argsort(k, kind="stable")
    s = k[order]
    later = np.zeros(len(k), bool)
    later[order[1:]] = s[1:] == s[:-1]
    return later


def repeated_words(t: Tokens, n: int = PASSAGE) -> np.ndarray:
    """Per word, whether it stands in a second or later copy of ``n`` successive words of its text."""
    g, at = grams(t.h, t.block, n)
    starts = at[later_copies(g, t.block[at])]
    cover = np.zeros(len(t.h) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, np.minimum(starts + n, len(t.h)), -1)
    return np.cumsum(cover)[:-1] > 0


def own_tokens(texts: list[str], model: LineModel | None, stamped: list | None = None) -> Tokens:
    """Tokens of the texts without stamped lines (those in ``stamped`` and those that the model tells) and page
    numbers; parted words put together."""
    t = tokens(without_recurring(texts, stamped), join_hyphens=True)
    return t if model is None else only_words(t, ~(model.stamped(t) | page_numbers(t))[t.line])


def only_words(t: Tokens, keep: np.ndarray) -> Tokens:
    return replace(t, h=t.h[keep], line=t.line[keep], block=t.block[keep])


def _features(t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature, text of each, and which are later copies."""
    g, at = grams(t.h, t.block, GRAM)
    text = t.block[at]
    later = later_copies(g, text)
    return (g >> 20 & (BUCKETS - 1)) + BUCKETS * later, text, later


def _texts(batch: pa.RecordBatch, column: int) -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def _stamped(batch: pa.RecordBatch, column: int) -> list:
    """Keys of stamped lines of each text, if the batch has them."""
    return batch.column(column).to_pylist() if batch.num_columns > column else [None] * batch.num_rows


def _measure(model: LineModel | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, stamped = batch.column(0), _texts(batch, 1), _stamped(batch, 2)
            for a, b in slices(texts):
                t = own_tokens(texts[a:b], model, stamped[a:b])
                f, text, later = _features(t)
                ends = np.cumsum(np.bincount(text, minlength=b - a)[: b - a], dtype=np.int64)
                # a repeated passage holds later copies of shorter n-grams, so a text without any has share 0
                hit = np.bincount(text[later], minlength=b - a)[: b - a] > 0
                t = only_words(t, hit[t.block])
                words = np.bincount(t.block, minlength=b - a)[: b - a]
                again = np.bincount(t.block[repeated_words(t)], minlength=b - a)[: b - a]
                share = np.where(hit, again / np.maximum(words, 1), 0.0)
                offsets = pa.py_buffer(np.append(0, 2 * ends).astype(np.int64).tobytes())
                features = pa.Array.from_buffers(pa.large_binary(), b - a, [None, offsets, pa.py_buffer(f.astype("<u2").tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), features, pa.array(share)], ["id", "features", "repeated_share"])

    return run


def measured(texts: DataFrame, model: LineModel | None) -> DataFrame:
    """``id, features, repeated_share`` of each row of ``texts`` (an id, a text, and the keys of stamped lines if there are any)."""
    return cut(texts.mapInArrow(_measure(model), "id bigint, features binary, repeated_share double"))


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The features of a batch of texts, and the number of each text."""
    offsets = np.append(0, np.cumsum(pa.compute.binary_length(column).to_numpy(zero_copy_only=False)))
    f = np.frombuffer(b"".join(column.to_pylist()), "<u2").astype(np.int64)
    return f, np.diff(offsets) // 2


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, 2 * BUCKETS), np.int64)
    for batch in batches:
        f, n = _unpacked(batch.column(0))
        text = np.repeat(np.arange(len(n)), n)
        trusted = np.bincount(text[f >= BUCKETS], minlength=len(n)) == 0
        total[1] += np.bincount(f, minlength=2 * BUCKETS)
        total[0] += np.bincount(f[trusted[text]], minlength=2 * BUCKETS)
    some = np.flatnonzero(total[1])
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0][some]), pa.array(total[1][some])], ["feature", "target", "raw"])


def log_ratios(features: DataFrame) -> np.ndarray:
    """ln(target/raw) of each feature, counted over all rows of ``features`` (one column, as :func:`measured` gives it).

    Each task returns at most ``2 * BUCKETS`` sums, and so does the whole: its size is fixed.
    """
    counted = features.mapInArrow(_count, "feature bigint, target bigint, raw bigint")
    counts = np.zeros((2, 2 * BUCKETS))
    for r in counted.groupBy("feature").agg(F.sum("target").alias("t"), F.sum("raw").alias("r")).collect():
        counts[:, r["feature"]] = r["t"], r["r"]
    # a bucket is smoothed by one count that is split as its class (first or later copies) is
    kind = counts.reshape(2, 2, BUCKETS)
    share = (kind.sum(axis=2) + 0.5) / (kind.sum(axis=(1, 2))[:, None] + 1)
    p = (kind + share[:, :, None]) / (kind.sum(axis=(1, 2))[:, None, None] + BUCKETS)
    return np.log(p[0] / p[1]).reshape(-1)


def threshold(ratios: np.ndarray) -> float:
    """The ratio of a text whose share of later copies is ``LATER_SHARE`` and whose features
    are, of both kinds, the least suspicious of their kind."""
    first, later = ratios[:BUCKETS], ratios[BUCKETS:]
    return float(LATER_SHARE * later.max() + (1 - LATER_SHARE) * first.max())


def _scorer(ratios: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f, n = _unpacked(batch.column(1))
            text = np.repeat(np.arange(len(n)), n)
            llr = np.bincount(text, weights=ratios[f], minlength=len(n)) / np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(llr), batch.column(2)], ["id", "llr", "repeated_share"])

    return run


def repetition(texts: DataFrame, id_col: str, text_col: str, model: LineModel | None = None, all_rows: bool = True, recurring: DataFrame | None = None) -> DataFrame:
    """``id, llr, repeated_share`` of each text: the length-normalised log-likelihood ratio and
    the share of words in a second or later copy of a passage.

    Rows with a null id are left out. A null, empty or short text (fewer than ``GRAM`` words)
    has ratio and share 0. Repeated rows of an id come out as often as they go in. Without
    ``all_rows`` only texts at or below the threshold come out; all cases are among them.
    An empty table gives an empty result. Other columns are ignored, but with ``recurring``
    (see ``furniture.recurring_lines``) ``name`` is that of the text's preview.
    """
    named = [] if recurring is None else ["name"]
    rows = texts.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"), *named)
    rows = spread(rows)
    if recurring is not None:
        rows = with_recurring(rows, recurring, "name")
    known = measured(rows, model)
    ratios = log_ratios(known.select("features"))
    scored = known.mapInArrow(_scorer(ratios), "id bigint, llr double, repeated_share double")
    # a text without n-grams is no case whatever the threshold
    return scored if all_rows else scored.where((F.col("llr") < 0) & (F.col("llr") <= threshold(ratios)))


def block_repetition(blocks: DataFrame, all_rows: bool = True) -> DataFrame:
    """``block_id, llr, repeated_share`` of each block (once), stamped lines left out."""
    read = read_lines(blocks)
    recurring = recurring_lines(read)
    model = fit_on_sample(distinct_lines(read, recurring))
    r = repetition(blocks, "block_id", "markdown", model, all_rows, recurring)
    return r.groupBy(F.col("id").alias("block_id")).agg(F.min("llr").alias("llr"), F.max("repeated_share").alias("repeated_share"))


def repeated_blocks(blocks: DataFrame) -> DataFrame:
    """``block_id`` of the blocks in which at least ``MIN_SHARE`` of the words are repeated."""
    return block_repetition(blocks, all_rows=False).where(F.col("repeated_share") >= MIN_SHARE).select("block_id")
