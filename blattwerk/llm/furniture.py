"""Lines that are stamped on a page and not its own text.

A line that comes back on many pages of one preview, numbers masked, is stamped:
lines are counted by (preview, key) over all blocks, and those over the rule's
bounds are joined to the blocks of their preview.

Stamped lines that do not come back are told by a small log-odds classifier over
hashed words and word pairs of a line. It is fitted on every distinct line of all
blocks, labelled by the same rule: lines meet by their key, and only the counts of
the buckets reach the driver. The model has a fixed size and is applied to every
line of every block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blattwerk.llm.textkernel import NUMBER, Tokens, line_keys, line_starts, segment_sum, skeleton, slices, tokens, word_hash
from blattwerk.plans import broadcast_if_small, cut, spread

#: A stamped line stands in this many blocks and this share of the blocks of its preview, and has this many words.
MIN_BLOCKS, MIN_SHARE, MIN_WORDS = 3, 0.04, 3
#: Features, and those of a row of counts.
BUCKETS, RANGE = 1 << 19, 1 << 13
#: Most tasks a core that count features; each returns ``2 * BUCKETS`` counts.
TASKS = 16
#: Bound of a feature's weight against a stamped line; weight of a feature that no line has.
MOST_AGAINST, UNSEEN = 2.0, -0.5
_PAIR = np.int64(0x5851F42D4C957F2D)

# What may stand beside the number in a page-number line.
PAGE_WORDS = ("seite", "blatt", "page", "pag", "von", "of", "s", "p", "bl", "sheet")
def is_page_number(line: str) -> bool:
    """Whether a line is nothing but a page number, with or without its words and marks."""
    t = line.strip()
    if not t or len(t) > 40:
        return False
    t = t.lower()
    if t[0] == ">" or t.startswith("[^") or t[-1] in ".,;:" or t[-1] == ")" and t[0] != "(" or not (any(c.isdigit() for c in t) or any(w in t for w in ("seite", "blatt"))):
        return False
    parts = re.findall(r"[^\W_]+", t)
    numbers = [p for p in parts if re.fullmatch(r"[\dlioqzsb]{1,5}", p) and (any(c.isdigit() for c in p) or len(parts) > 1 and p not in PAGE_WORDS)]
    words = [p for p in parts if p not in numbers]
    return 1 <= len(numbers) <= 2 and all(_is_page_word(w) for w in words) and (len(numbers) == 1 or bool(words))


def _is_page_word(w: str) -> bool:
    return w in PAGE_WORDS or len(w) > 2 and skeleton(w) in _PAGE_SKELETONS


_PAGE_SKELETONS = {skeleton(w) for w in PAGE_WORDS if len(w) > 2}


@dataclass
class LineModel:
    """Log-odds of hashed words and pairs (``weights``), fixed in size; ``bias`` is the prior."""

    weights: np.ndarray
    bias: float

    def stamped(self, t: Tokens) -> np.ndarray:
        """Per line, whether it is stamped. Lines of fewer than three words never are (page numbers: ``is_page_number``)."""
        f, line = _features(_short(t.h), t.line)
        size = np.bincount(t.line, minlength=t.n_lines)[: t.n_lines]
        n = np.bincount(line, minlength=t.n_lines)[: t.n_lines]
        score = segment_sum(self.weights[f], line, t.n_lines)
        unseen = segment_sum(self.weights[f] == UNSEEN, line, t.n_lines)
        return (size >= 3) & (unseen < 0.6 * n) & (score / np.sqrt(np.maximum(n, 1)) + self.bias > 0)


def _short(h: np.ndarray) -> np.ndarray:
    """32 bits of each hash: far more than the buckets tell apart, and half as much to send."""
    return (h ^ (h >> 32)) & 0xFFFFFFFF


def _features(h: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of the words ``h`` (see :func:`_short`), and the line of each."""
    if len(h) == 0:
        return np.zeros(0, np.int64), line
    same = line[1:] == line[:-1]
    with np.errstate(over="ignore"):
        pair = (h[:-1] * _PAIR) ^ (h[1:] >> 7) ^ h[1:]
    pair, pair_line = pair[same], line[:-1][same]
    mix = lambda x: ((x ^ (x >> 29)) * np.int64(0x2545F4914F6CDD1D) >> 40) & (BUCKETS - 1)
    with np.errstate(over="ignore"):
        f = np.concatenate([mix(h), mix(pair)])
    return f, np.concatenate([line, pair_line])


def _packed(t: Tokens, key: np.ndarray, size: np.ndarray) -> bytes:
    """The lines of two words or more, each key once, as an Arrow stream of ``key`` and ``words``."""
    some = np.flatnonzero(size >= 2)
    chosen = np.zeros(t.n_lines, bool)
    chosen[some[np.unique(key[some], return_index=True)[1]]] = True
    offsets, words = np.append(0, 4 * np.cumsum(size[chosen])).astype(np.int32), _short(t.h[chosen[t.line]]).astype("<u4")
    lines = pa.RecordBatch.from_arrays([pa.array(key[chosen]), pa.Array.from_buffers(pa.binary(), int(chosen.sum()), [None, pa.py_buffer(offsets), pa.py_buffer(words)])], ["key", "words"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, lines.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(lines)
    return sink.getvalue().to_pybytes()


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lines in batch.column(0):
            yield from pa.ipc.open_stream(lines.as_buffer())


def distinct_lines(read: DataFrame, recurring: DataFrame) -> DataFrame:
    """``key`` and ``words`` (short hashes) of the lines of two words or more, over all of ``read`` (see :func:`read_lines`),
    and whether a line is ``stamped`` in some preview (``recurring``: see :func:`recurring_lines`).

    A key comes once a slice of texts, so a line that stands in many blocks is no hot task.
    """
    lines = read.where(F.col("lines").isNotNull()).select("lines").mapInArrow(_unpacked, "key bigint, words binary")
    stamped = cut(recurring.select(F.explode("stamped").alias("key")).distinct()).withColumn("stamped", F.lit(True))
    return lines.join(broadcast_if_small(stamped), "key", "left").select("key", "words", F.coalesce("stamped", F.lit(False)).alias("stamped"))


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many lines have each feature, stamped ones and others, a row for ``RANGE`` of them; ``place`` -1 has the lines themselves.

    Rows of a key follow each other.
    """
    total, lines = np.zeros((2, BUCKETS), np.int64), np.zeros((2, 1), np.int64)
    last = None
    for batch in batches:
        key = batch.column(0).to_numpy()
        if not len(key):
            continue
        # lines of one key have the same words, so it does not matter which of them counts
        once = np.append(last is None or key[0] != last, key[1:] != key[:-1])
        last = key[-1]
        words, stamped = batch.column(1).cast(pa.binary()), batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(key) + 1]
        h = np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]].view("<u4").astype(np.int64)
        f, line = _features(h, np.repeat(np.arange(len(key)), np.diff(ends) // 4))
        for kind, mask in enumerate((stamped & once, ~stamped & once)):
            lines[kind] += mask.sum()
            total[kind] += np.bincount(f[mask[line]], minlength=BUCKETS)
    counts = [lines.tobytes(), *(total[:, a : a + RANGE].tobytes() for a in range(0, BUCKETS, RANGE))]
    yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(counts) - 1), pa.int32()), pa.array(counts, pa.binary())], ["place", "counts"])


def _summed(rows: pa.Table) -> pa.Table:
    counts = sum(np.frombuffer(x.as_buffer(), np.int64) for x in rows.column("counts"))
    return pa.table({"place": rows.column("place")[:1], "counts": pa.array([counts.tobytes()], pa.binary())})


def fit_on_lines(lines: DataFrame, smooth: float = 1.0) -> LineModel:
    """Model from all of ``lines`` (see :func:`distinct_lines`).

    Each key counts once, so that frequent lines do not outweigh the others. There are at most ``TASKS`` tasks a core; what a
    task returns has a fixed size, and so have the sums.
    """
    tasks = TASKS * lines.sparkSession.sparkContext.defaultParallelism
    schema = "place int, counts binary"
    counted = lines.repartition("key").sortWithinPartitions("key").coalesce(tasks).mapInArrow(_count_features, schema)
    sums = counted.groupBy("place").applyInArrow(_summed, schema).collect()
    by_place = {r["place"]: np.frombuffer(r["counts"], np.int64).reshape(2, -1).astype(float) for r in sums}
    if not by_place:
        return LineModel(np.zeros(BUCKETS), -1.0)
    count = np.concatenate([by_place[i] for i in sorted(by_place)], axis=1)
    (n_stamped, n_other), (pos_n, neg_n) = count[:, 0], count[:, 1:]
    if n_stamped + n_other == 0:
        return LineModel(np.zeros(BUCKETS), -1.0)
    share = (pos_n.sum() + 1) / (pos_n.sum() + neg_n.sum() + 2)
    # shrunk towards the prior, so that rare features weigh little
    w = np.log((pos_n + smooth * share) / (neg_n + smooth * (1 - share))) - np.log(share / (1 - share))
    # a slot in a stamped line may hold any word of the texts, so single words do not weigh much against it
    w = np.maximum(w, -MOST_AGAINST)
    w[(pos_n + neg_n) == 0] = UNSEEN
    prior = np.log((n_stamped + 1) / max(1.0, n_other))
    return LineModel(w.astype(np.float32), float(prior) / 2)


def _block_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2).to_pylist()
        for a, b in slices(texts):
            t = tokens(texts[a:b], join_hyphens=False)
            line_key, size = line_keys(t), np.bincount(t.line, minlength=t.n_lines)[: t.n_lines]
            use = np.flatnonzero((size >= MIN_WORDS) & (line_key != 0))
            # each key once a block; key 0 stands for the block itself
            block = np.concatenate([np.arange(b - a), t.line_block[use]])
            key = np.concatenate([np.zeros(b - a, np.int64), line_key[use]])
            order = np.lexsort((key, block))
            block, key = block[order], key[order]
            once = np.append(True, (block[1:] != block[:-1]) | (key[1:] != key[:-1]))
            block, key = block[once], key[once]
            keys = pa.ListArray.from_arrays(pa.array(np.searchsorted(block, np.arange(b - a + 1)).astype(np.int32)), pa.array(key))
            lines = pa.array([_packed(t, line_key, size), *[None] * (b - a - 1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), keys, lines], ["block_id", "preview", "keys", "lines"])


def read_lines(blocks: DataFrame) -> DataFrame:
    """``block_id, preview`` (a hash of ``name``) and ``keys`` of the lines of each row of ``blocks``; the first row of a slice of texts
    has its ``lines``, packed (see :func:`distinct_lines`). Texts are read once for both.

    Blocks with a null id or name, or without text, are left out.
    """
    text = F.col("markdown").cast("string")
    narrow = blocks.where(F.col("block_id").isNotNull() & F.col("name").isNotNull() & (F.coalesce(text, F.lit("")) != ""))
    narrow = spread(narrow.select(F.col("block_id").cast("bigint").alias("block_id"), F.xxhash64("name").alias("preview"), text.alias("markdown")))
    return cut(narrow.mapInArrow(_block_lines, "block_id bigint, preview bigint, keys array<bigint>, lines binary"))


def recurring_lines(read: DataFrame) -> DataFrame:
    """``preview`` and ``stamped``, the keys of the lines that come back in it, over all of ``read`` (see :func:`read_lines`).

    Repeated rows of a block count once. Pairs are counted with partial aggregation, so a preview that holds a large
    share of the blocks is no hot task.
    """
    rows = read.select("block_id", "preview", "keys").dropDuplicates(["block_id"])
    pairs = rows.select("preview", F.explode("keys").alias("key")).groupBy("preview", "key").agg(F.count(F.lit(1)).alias("k"))
    often = cut(pairs.where(F.col("k") >= MIN_BLOCKS))
    size = often.where("key = 0").select("preview", F.col("k").alias("n"))
    over = often.where("key <> 0").join(size, "preview").where(F.col("k") >= MIN_SHARE * F.col("n"))
    return cut(over.groupBy("preview").agg(F.collect_list("key").alias("stamped")))


def with_recurring(rows: DataFrame, recurring: DataFrame, name_col: str) -> DataFrame:
    """``rows`` with the column ``stamped`` of :func:`recurring_lines` instead of ``name_col``; null where nothing comes back."""
    hashed = rows.withColumn("preview", F.when(F.col(name_col).isNotNull(), F.xxhash64(name_col))).drop(name_col)
    return hashed.join(broadcast_if_small(recurring), "preview", "left").drop("preview")


def recurs(t: Tokens, stamped: list) -> np.ndarray:
    """Per line, whether its key is among those of its text (``stamped``: a list of keys, or None, a text)."""
    sizes = [len(x) if x else 0 for x in stamped]
    if not any(sizes):
        return np.zeros(t.n_lines, bool)
    known = np.array([k for x in stamped if x for k in x], np.int64)
    with np.errstate(over="ignore"):
        known ^= np.repeat(np.arange(len(stamped)), sizes) * _PAIR
        key = line_keys(t) ^ (t.line_block * _PAIR)
    return np.isin(key, known) & (np.bincount(t.line, minlength=t.n_lines)[: t.n_lines] >= MIN_WORDS)


def without_recurring(texts: list[str], stamped: list | None) -> list[str]:
    """The texts without the lines whose keys are in ``stamped`` (see :func:`recurs`)."""
    some = [i for i, x in enumerate(stamped or []) if x and texts[i]]
    if not some:
        return texts
    out = list(texts)
    t = tokens([texts[i] for i in some], join_hyphens=False)
    gone, first = recurs(t, [stamped[i] for i in some]), line_starts(t).tolist()
    for i, a in zip(some, first, strict=True):
        lines = texts[i].split("\n")
        off = gone[a : a + len(lines)]
        if off.any():
            out[i] = "\n".join(x for x, o in zip(lines, off, strict=True) if not o)
    return out


_PAGE_HASHES = np.array(sorted({word_hash(w) for w in PAGE_WORDS}), np.int64)


def page_numbers(t: Tokens) -> np.ndarray:
    """Per line of tokens, whether it is a page number: one or two numbers and else only page words."""
    number = t.h == NUMBER
    numbers = np.bincount(t.line[number], minlength=t.n_lines)[: t.n_lines]
    others = np.bincount(t.line[~number & ~np.isin(t.h, _PAGE_HASHES)], minlength=t.n_lines)[: t.n_lines]
    size = np.bincount(t.line, minlength=t.n_lines)[: t.n_lines]
    return (others == 0) & (numbers >= 1) & (numbers <= 2) & (size <= 4)
