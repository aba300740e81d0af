"""Figures of a text that tell running prose from lists, tables, drawings and junk.

Huge texts are cut into chunks, each chunk yields counts that add up, and the counts
of a text are summed by Spark's partial aggregation, as a tree. What a cut could part
is carried over it: parted words are joined first, lines longer than ``LONG_LINE`` are
counted where they end, and passages are compared over the whole text. So the counts
are the same for every size of a chunk. Ratios and the rule are derived from the sums.
The rule is linear in the ratios; it starts from fixed weights and is fitted on all
rated texts, with the fixed weights as prior; each step of the fit sums over them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blattwerk.llm.furniture import LineModel, distinct_lines, fit_on_lines, page_numbers, read_lines, recurring_lines, with_recurring, without_recurring
from blattwerk.llm.repetition import only_words, repeated_words
from blattwerk.llm.textkernel import NUMBER, Tokens, prepare, slices, tokenised, word_hash
from blattwerk.plans import cut, spread

#: Characters of a chunk, and of a part of a line that is judged by itself if the line is longer.
CHUNK, LONG_LINE = 1_000_000, 2_000
#: Ranks of the vocabulary that count as common words.
COMMON_RANKS = 50
#: Strength of the prior weights, in rated texts.
PRIOR = 1.0

# Articles, which lists and tables of contents hold as well as prose.
ARTICLES = ("der", "die", "das", "den", "dem", "des", "ein", "eine", "einen", "einem", "einer", "eines", "the", "a", "an")
# Lines of markup that are no running text of the page: embedded pictures, the
# heads of folded notes, and footnotes.
_MARKUP = re.compile(r"(?:(?<=[\n\x00])|\A)[ \t>]*(?:!\[\[|\[![a-z]+\]|\[\^\w+\]:)[^\n\x00]*")

COUNTS = ("words", "all_words", "repeated_words", "letters", "single_letters", "numbers", "articles", "common", "symbols", "chars", "lines", "lines_punct", "sentence_ends")
RATIOS = ("common_share", "article_share", "number_share", "single_share", "sentence_rate", "symbol_ratio", "punct_share", "word_length")
# Weights of the rule in the order of RATIOS, and its constant; positive for prose.
PRIOR_WEIGHTS = (24.0, 4.0, -4.0, -4.0, 8.0, -4.0, 0.5, 0.0)
PRIOR_CONSTANT = -4.0

_SPACE, _LETTER, _DIGIT, _STOP, _POINT, _SYMBOL, _REST = range(7)


def _classes() -> np.ndarray:
    c = np.full(256, _SYMBOL, np.uint8)
    c[list(b" \t\r\n\x00\x01\x0b\x0c")] = _SPACE
    c[list(b"abcdefghijklmnopqrstuvwxyz")] = _LETTER
    c[list(b"0123456789")] = _DIGIT
    c[list(b".!?")] = _STOP
    c[list(b",;:-()\"'")] = _POINT
    c[0x80:0xC0] = _REST  # later bytes of a character
    c[0xC3:0xF0] = _LETTER  # by first byte: letters of all scripts ...
    c[[0xE2, 0xEF]] = _SYMBOL  # ... but dashes, quotes, bullets, arrows, box drawing and private ones
    return c


_CLASS = _classes()


def chunks(text: str, size: int = CHUNK) -> list[str]:
    """Prepared text in pieces of whole lines (or parts of long lines), each with the mark that ends it but the last."""
    out, at = [], 0
    while len(text) - at > size:
        ends = [i for i in (text.find("\n", at + size), text.find("\x01", at + size)) if i >= 0]
        if not ends:
            break
        out.append(text[at : min(ends) + 1])
        at = min(ends) + 1
    return [*out, text[at:]]


def _line_figures(t: Tokens) -> tuple[np.ndarray, ...]:
    """Per line: letters, symbols, characters without blanks, sentence ends, and whether it ends in a stop."""
    buf = np.frombuffer(t.text.encode("utf-8", "replace"), np.uint8)
    cls = _CLASS[buf]
    breaks = np.flatnonzero((buf == 10) | (buf <= 1))
    bounds = np.concatenate([[0], breaks, [len(buf)]])

    def per_line(mask: np.ndarray) -> np.ndarray:
        # an empty first line gives the mark that ends it, which is in no mask
        return np.add.reduceat(mask.view(np.uint8), bounds[:-1], dtype=np.int32) if len(mask) else np.zeros(len(bounds) - 1, np.int32)

    seen = (cls != _SPACE) & (cls != _REST)
    stop = cls == _STOP
    sentence = np.zeros(len(buf), bool)
    if len(buf) > 1:
        after = np.append(cls[1:], _SPACE)
        sentence[1:] = stop[1:] & ((cls[:-1] == _LETTER) | (cls[:-1] == _REST)) & ((after[1:] == _SPACE) | (after[1:] == _POINT))
    chars = per_line(seen)
    last = np.flatnonzero(seen)
    ends = np.zeros(len(bounds) - 1, bool)
    if len(last):
        k = np.searchsorted(last, bounds[1:]) - 1
        some = (chars > 0) & (k >= 0)
        ends[some] = np.isin(buf[last[k[some]]], np.frombuffer(b".!?:;", np.uint8))
    return per_line(cls == _LETTER), per_line(cls == _SYMBOL), chars, per_line(sentence), ends


def partial_counts(texts: list[str], model: LineModel | None, articles: np.ndarray, common: np.ndarray) -> np.ndarray:
    """One row of ``COUNTS`` a text: its own lines, each repeated passage once."""
    t = tokenised(prepare(texts, True, _MARKUP, LONG_LINE), len(texts))
    own = _own_lines(t, model)
    return _counts(t, own, repeated_words(only_words(t, own[t.line])), articles, common)


def chunk_counts(text: str, model: LineModel | None, articles: np.ndarray, common: np.ndarray, size: int) -> np.ndarray:
    """One row of ``COUNTS`` for each chunk of a huge text; the rows add up to the counts of the whole."""
    pieces = chunks(prepare([text], True, _MARKUP, LONG_LINE), size)
    parts = [tokenised(p, 1) for p in pieces[:-1]]
    for t in parts:  # the line after the mark that ends a piece is the next one's
        t.n_lines, t.line_block, t.line_letters, t.goes_on = t.n_lines - 1, t.line_block[:-1], t.line_letters[:-1], t.goes_on[:-1]
    parts.append(tokenised(pieces[-1], 1))
    own = [_own_lines(t, model) for t in parts]
    words = [only_words(t, o[t.line]) for t, o in zip(parts, own, strict=True)]
    h = np.concatenate([w.h for w in words])
    again = repeated_words(replace(words[0], h=h, block=np.zeros(len(h), np.int64)))
    ends = np.cumsum([len(w.h) for w in words])
    return np.vstack([_counts(t, o, a, articles, common) for t, o, a in zip(parts, own, np.split(again, ends[:-1]), strict=True)])


def _own_lines(t: Tokens, model: LineModel | None) -> np.ndarray:
    return np.ones(t.n_lines, bool) if model is None else ~(model.stamped(t) | page_numbers(t))


def _counts(t: Tokens, own: np.ndarray, again: np.ndarray, articles: np.ndarray, common: np.ndarray) -> np.ndarray:
    """``again`` says of each word of the lines in ``own`` whether it stands in a later copy of a passage."""
    n = t.n_blocks
    kept = own[t.line]
    w = only_words(t, kept)
    size = np.bincount(w.line, minlength=t.n_lines)[: t.n_lines]
    fresh = np.bincount(w.line[~again], minlength=t.n_lines)[: t.n_lines]
    own = own & ((size == 0) | (fresh > 0))  # a line that only repeats is judged where it stood first
    real = np.bincount(w.line[w.h != NUMBER], minlength=t.n_lines)[: t.n_lines]
    w = only_words(w, ~again)
    letters, symbols, chars, sentences, ends = (x[: t.n_lines] for x in _line_figures(t))
    line = np.flatnonzero(own & (t.line_letters[: t.n_lines] + size + chars > 0))
    block = t.line_block[line]
    per = lambda x: np.bincount(block, weights=x[line], minlength=n)[:n]
    word = w.h != NUMBER
    count = lambda mask: np.bincount(w.block[mask], minlength=n)[:n]
    done = ~t.goes_on
    return np.column_stack(
        [
            count(word), per(real), np.bincount(t.block[kept][again], minlength=n)[:n], per(letters), per(t.line_letters), count(~word), count(np.isin(w.h, articles)), count(np.isin(w.h, common)),
            per(symbols), per(chars), per(done.astype(float)), per((ends & done).astype(float)), per(sentences),
        ]
    ).astype(np.int64)


def _counter(model: LineModel | None, articles: np.ndarray, common: np.ndarray, chunk: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["id", "chunk", *COUNTS]

    def rows(ids: np.ndarray, number: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(number.astype(np.int32)), *(pa.array(c) for c in counts.T)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), [x or "" for x in batch.column(1).to_pylist()]
            stamped = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * len(texts)
            for a, b in slices(texts):
                own = without_recurring(texts[a:b], stamped[a:b])
                short = [i for i, x in enumerate(own) if len(x) <= chunk]
                if short:
                    yield rows(ids[a:b][short], np.zeros(len(short)), partial_counts([own[i] for i in short], model, articles, common))
                for i in set(range(b - a)) - set(short):
                    counts = chunk_counts(own[i], model, articles, common, chunk)
                    yield rows(np.repeat(ids[a + i], len(counts)), np.arange(len(counts)), counts)

    return run


def common_words(vocab: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the articles, and of the other words of the first ``COMMON_RANKS`` ranks of ``vocab`` (a parameter)."""
    words = [r["word"] for r in vocab.where((F.col("freq_rank") <= COMMON_RANKS) & F.col("word").isNotNull()).select("word").distinct().collect()]
    articles = np.array(sorted({word_hash(w) for w in ARTICLES} - {0}), np.int64)
    return articles, np.setdiff1d(np.array(sorted({word_hash(w) for w in words} - {0}), np.int64), articles)


def text_counts(texts: DataFrame, id_col: str, text_col: str, vocab: DataFrame, model: LineModel | None = None, chunk: int = CHUNK, recurring: DataFrame | None = None) -> DataFrame:
    """``id`` and ``COUNTS`` of each text.

    Rows with a null id are left out; null and empty texts have counts of 0; rows that repeat
    an id are taken for deliveries of one text (the greatest counts hold); an empty table
    gives an empty result. ``vocab`` (``word, freq_rank``) gives the common words, those of the
    first ``COMMON_RANKS`` ranks. Words are runs of letters of any script, accents apart. Columns other than those named are ignored, but with ``recurring``
    (see ``furniture.recurring_lines``) ``name`` is that of the text's preview.
    """
    articles, common = common_words(vocab)
    rows = texts.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"), *([] if recurring is None else ["name"]))
    rows = spread(rows) if recurring is None else with_recurring(spread(rows), recurring, "name")
    schema = "id bigint, chunk int, " + ", ".join(f"{c} bigint" for c in COUNTS)
    parts = rows.mapInArrow(_counter(model, articles, common, chunk), schema)
    one = parts.groupBy("id", "chunk").agg(*[F.max(c).alias(c) for c in COUNTS])
    return one.groupBy("id").agg(*[F.sum(c).alias(c) for c in COUNTS])


def ratios() -> list[Column]:
    """The columns ``RATIOS`` of a frame of counts; 0 where a text has nothing to divide by."""

    def over(a: Column | str, b: Column | str) -> Column:
        a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    everything = F.col("words") + F.col("numbers") + F.col("single_letters")
    return [
        over("common", "words").alias("common_share"),
        over("articles", "words").alias("article_share"),
        over("numbers", everything).alias("number_share"),
        over("single_letters", everything).alias("single_share"),
        F.least(over("sentence_ends", "words"), F.lit(0.2)).alias("sentence_rate"),
        over("symbols", "chars").alias("symbol_ratio"),
        over("lines_punct", "lines").alias("punct_share"),
        over(F.col("letters") - F.col("single_letters"), "all_words").alias("word_length"),
    ]


def _slopes(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Gradient (first column) and curvature of the loss at the weights ``w``, summed over the rows of ``x``, ratios and labels."""
    x = np.column_stack([x, np.ones(len(x))])
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return np.column_stack([x.T @ (p - y), (x * (p * (1 - p) + 1e-6)[:, None]).T @ x])


def _fitted(slopes: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, float]:
    """Weights and constant of the logistic rule by Newton's steps; ``slopes`` gives the sums of :func:`_slopes` over all rows."""
    prior = np.array([*PRIOR_WEIGHTS, PRIOR_CONSTANT])
    scale = np.array([0.1, 0.1, 0.1, 0.2, 0.03, 0.1, 0.3, 4.0, 1.0])  # usual spread of each ratio
    pull = PRIOR * scale**2
    w = prior.copy()
    for _ in range(30):
        sums = slopes(w)
        step = np.linalg.solve(sums[:, 1:] + np.diag(pull), sums[:, 0] + pull * (w - prior))
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit_rule(rows: Sequence[Sequence[float]], prose: Sequence[bool]) -> tuple[np.ndarray, float]:
    """Weights and constant of the logistic rule, fitted with the fixed weights as prior."""
    x, y = np.asarray(rows, float).reshape(-1, len(RATIOS)), np.asarray(prose, float)
    return _fitted(lambda w: _slopes(x, y, w))


def fit_rule_on(known: DataFrame) -> tuple[np.ndarray, float]:
    """:func:`fit_rule` over all rows of ``known`` (``prose`` and ``RATIOS``); a step takes one sum of 90 numbers over them."""
    known = cut(known.select("prose", *RATIOS))
    shape = (len(RATIOS) + 1, len(RATIOS) + 2)

    def slopes(w: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                y, *x = (c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns)
                total += _slopes(np.column_stack(x), y, w)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.reshape(-1))], ["place", "value"])

        sums = np.zeros(shape)
        for r in known.mapInArrow(run, "place bigint, value double").groupBy("place").agg(F.sum("value").alias("value")).collect():
            sums.flat[r["place"]] = r["value"]
        return sums

    return _fitted(slopes)


def prose_weights(texts: list[str], articles: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Quality weight of each text, from 0 to 1: how likely the rule with its fixed weights takes it for running
    prose, times the share of its words that repeat no passage."""
    c = dict(zip(COUNTS, partial_counts(texts, None, articles, common).T.astype(float), strict=True))

    def over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)

    everything = c["words"] + c["numbers"] + c["single_letters"]
    x = (
        over(c["common"], c["words"]), over(c["articles"], c["words"]), over(c["numbers"], everything), over(c["single_letters"], everything),
        np.minimum(over(c["sentence_ends"], c["words"]), 0.2), over(c["symbols"], c["chars"]), over(c["lines_punct"], c["lines"]), over(c["letters"] - c["single_letters"], c["all_words"]),
    )
    score = PRIOR_CONSTANT + sum(w * v for w, v in zip(PRIOR_WEIGHTS, x, strict=True))
    return over(c["words"], c["words"] + c["repeated_words"]) / (1 + np.exp(-score))


def text_quality(texts: DataFrame, id_col: str, text_col: str, vocab: DataFrame, model: LineModel | None = None, chunk: int = CHUNK, recurring: DataFrame | None = None) -> DataFrame:
    """Counts and ratios of each text; see :func:`text_counts` for odd rows."""
    c = text_counts(texts, id_col, text_col, vocab, model, chunk, recurring)
    return c.select("*", *ratios())


def block_quality(blocks: DataFrame, vocab: DataFrame) -> DataFrame:
    """``block_id``, counts and ratios of each block (once), stamped lines and page numbers left out."""
    read = read_lines(blocks)
    recurring = recurring_lines(read)
    model = fit_on_lines(distinct_lines(read, recurring))
    return text_quality(blocks, "block_id", "markdown", vocab, model, recurring=recurring).withColumnRenamed("id", "block_id")


def rated(kinds: DataFrame) -> DataFrame:
    """``block_id, prose`` of the blocks that most raters call prose or not; even votes are left out."""
    votes = kinds.where(F.col("block_id").isNotNull() & F.col("kind").isNotNull()).groupBy("block_id").agg(F.avg((F.col("kind") == "prose").cast("double")).alias("share"))
    return votes.where(F.col("share") != 0.5).select("block_id", (F.col("share") > 0.5).alias("prose"))


def judged_blocks(quality: DataFrame, kinds: DataFrame) -> DataFrame:
    """``quality`` with ``prose_score`` (positive: running prose) and ``not_prose``.

    The rule is fitted on all rated blocks.
    """
    weights, constant = fit_rule_on(quality.join(rated(kinds), "block_id").where(F.col("words") > 0))
    score = F.lit(constant)
    for c, w in zip(RATIOS, weights, strict=True):
        score = score + F.col(c) * float(w)
    something = (F.col("words") + F.col("numbers") + F.col("single_letters") + F.col("symbols")) > 0
    return quality.withColumn("prose_score", score).withColumn("not_prose", something & (F.col("prose_score") < 0))


def blocks_not_prose(blocks: DataFrame, vocab: DataFrame, kinds: DataFrame) -> DataFrame:
    """``block_id`` of the blocks whose own text is not mainly running sentences."""
    return judged_blocks(cut(block_quality(blocks, vocab)), kinds).where("not_prose").select("block_id")


def plain_statistics(texts: DataFrame, id_col: str, text_col: str, vocab: DataFrame) -> DataFrame:
    """``id``, ``words, letters, common, symbols, chars, lines, lines_punct`` and the ratios ``word_length, common_share,
    symbol_ratio, punct_share`` of each whole text, as it stands.

    A word is a run of letters (of any script), a symbol what is neither letter, mark, digit, blank nor one of ``.,;:!?-()"'``;
    a line counts if it is not blank, and ends in punctuation if its last mark is one of ``.!?:;``. A word is common if it is, in
    lower case, one of the first ``COMMON_RANKS`` ranks of ``vocab``. Rows with a null id are left out, a null text counts
    as empty, repeated rows of an id count once (the greatest counts hold); ratios are 0 where there is nothing to divide by.
    """
    known = sorted({r["word"].lower() for r in vocab.where((F.col("freq_rank") <= COMMON_RANKS) & F.col("word").isNotNull()).select("word").distinct().collect()})
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = spread(texts.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), text.alias("text")))
    counted = rows.withColumn("ws", F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), F.lit(1))).select(
        "id",
        F.size("ws").cast("bigint").alias("words"),
        F.char_length(F.array_join("ws", "")).cast("bigint").alias("letters"),
        F.size(F.filter("ws", lambda w: F.lower(w).isin(known))).cast("bigint").alias("common"),
        F.regexp_count("text", F.lit(r"""[^\p{L}\p{M}\p{Nd}\s.,;:!?()"'-]""")).cast("bigint").alias("symbols"),
        F.regexp_count("text", F.lit(r"\S")).cast("bigint").alias("chars"),
        F.regexp_count("text", F.lit(r"(?md)^.*\S.*$")).cast("bigint").alias("lines"),
        F.regexp_count("text", F.lit(r"(?md)[.!?:;][ \t]*$")).cast("bigint").alias("lines_punct"),
    )
    one = counted.groupBy("id").agg(*[F.max(c).alias(c) for c in counted.columns if c != "id"])

    def over(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return one.select("*", over("letters", "words").alias("word_length"), over("common", "words").alias("common_share"), over("symbols", "chars").alias("symbol_ratio"), over("lines_punct", "lines").alias("punct_share"))
