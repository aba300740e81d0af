"""Noise in text from scanned pages: found, and repaired into paragraphs.

1. All blocks: how often each word form stands in trusted text (pages with a text
   layer) and elsewhere, words parted at line ends put together.
2. Forms are grouped by their glyph skeleton. A form that trusted text does not
   support is a misread one of a supported form of its group that differs in the
   fewest letters. The groups are joined, not gathered. The result is a table of
   distinct forms; where several forms are as near, all stay.
3. Scanned blocks: stamped lines (numbers masked, counted over all blocks, see ``furniture``), words parted
   at line ends, and words that may be misread, by a filter of fixed size. The
   candidates are joined with the table of forms. Among several, the one that trusted
   text has most often beside the same neighbours is chosen, then the most frequent.
4. Repair: without stamped lines, with right spellings, reflowed by SQL windows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blattwerk.llm.furniture import LineModel, distinct_lines, is_page_number, read_lines, recurring_lines, recurs, with_recurring
from blattwerk.llm.furniture import fit_on_lines as fit_on_sample  # the name by which tests put a model of their own
from blattwerk.llm.textkernel import CONJUNCTIONS, HYPHENS, RARE_GLYPHS, line_starts, skeleton, slices, tokens
from blattwerk.plans import broadcast_if_small, cut, spread

#: Origins of trusted text and of scanned text.
TRUSTED, SCANNED = "textlayer", "ocr"
#: The right form must have this many times the support of the misread one, and this support at least.
TIMES, LEAST = 3, 3
#: Bits of the filter of misread forms: for each form, and for all of them.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 26
#: A line longer than this is a paragraph and not a printed line.
PRINTED_LINE = 110
#: A preview is printed if its lines end within sentences this many times as often as they are too long.
PRINTED_TIMES = 3
#: Distinct forms that a task holds before it passes them on, and their letters.
FLUSH, FLUSH_LETTERS = 100_000, 4_000_000
#: Mean length of words above which a page holds codes.
LONG_WORDS = 25
#: Letters of the longest form for which the rare glyphs are tried, and of the shortest in capitals that is a word.
LONGEST, LEAST_CAPITALS = 60, 4

_WORD = re.compile(r"[^\W_]+")
_RUN = re.compile(r"[^\W\d_]{3,}")
_TOKEN = re.compile(r"[^\W_]+(?:-[^\W_]+)*")
_PARTED = re.compile(rf"([^\W_]+(?:[-‐][^\W_]+)*)[{HYPHENS}]\s*$")
_GOES_ON = re.compile(r"[^\w\s]*([a-zäöüß][^\W_]*(?:-[^\W_]+)*)")
_KEPT = re.compile(rf"(?:{'|'.join(CONJUNCTIONS)})\b")
_JOIN = re.compile(rf"[{HYPHENS}][ \t]*\n(?!(?:{'|'.join(CONJUNCTIONS)})\b)(?=[a-zäöüß])")
_LEADERS = re.compile(r"(?:\.{4,}|…{2,})\s*\d+\s*$")
_INDEX = re.compile(r"[^\W\d_]{2,}\s+\d+(?:,\s*\d+)*\s*$")


def is_junk(lines: list[str]) -> bool:
    """Whether lines are no words: symbols, spaced letters, codes, contents or an index."""
    full = [x for x in lines if x.strip()]
    if not full:
        return False
    words = " ".join(full).split()
    size = sum(map(len, words))
    # whole words are counted first: they are enough nearly everywhere
    lettered = sum([len(w) for w in words if len(w) > 2 and w.isalpha()])
    if lettered < 0.5 * size:
        lettered = sum(map(len, _RUN.findall(" ".join(words))))
    if lettered < 0.5 * size or size > LONG_WORDS * len(words):
        table = sum(x.lstrip().startswith("|") or "\t" in x or "   " in x.strip() for x in full)
        if table < 2 or sum(len(w) == 1 for w in words) > 0.6 * len(words) and len(words) > 20:
            return True
    numbered = [x for x in full if x.rstrip()[-1:].isdigit()]
    return len(numbered) >= 3 and sum(bool(_LEADERS.search(x) or _INDEX.match(x)) for x in numbered) >= max(3, 0.6 * len(full))


def _count_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trusted: Counter = Counter()
    other: Counter = Counter()
    votes: dict[str, list[int]] = {}

    def flush() -> pa.RecordBatch:
        forms = trusted.keys() | other.keys()
        rows = [(0, w, trusted[w], other[w]) for w in forms] + [(1, k, *v) for k, v in votes.items()]
        trusted.clear()
        other.clear()
        votes.clear()
        cols = list(zip(*rows, strict=True)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())], ["what", "key", "a", "b"])

    for batch in batches:
        for name, origin, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if not text:
                continue
            (trusted if origin == TRUSTED else other).update(_WORD.findall(_JOIN.sub("", text)))
            if origin is None and name is not None:
                v = votes.setdefault(name, [0, 0])
                for n, x in enumerate(printed(text)):
                    v[n] += x
            if len(text) > FLUSH_LETTERS:
                yield flush()
        if len(trusted) + len(other) > FLUSH:
            yield flush()
    yield flush()


def printed(text: str) -> tuple[int, int]:
    """Line ends within a sentence, and lines too long for a printed page."""
    lines = text.split("\n")
    long = sum(len(x) > PRINTED_LINE and "|" not in x for x in lines)
    wraps = sum(len(a) > 20 and b[:1].islower() and a.rstrip()[-1:] not in ".!?;:|" for a, b in zip(lines, lines[1:], strict=False))
    return wraps, long


def _skeletons(rare: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the skeleton of the first column as the last two, ``skeleton, tier``; with ``rare`` also (tier 1) those that
    a rare misreading may have had. Forms without two glyphs are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, low in enumerate(batch.column(0).to_pylist()):
                s = skeleton(low)
                if len(s) < 2 or low.isdigit():
                    continue
                out.append((i, s, 0))
                if rare and 3 < len(low) <= LONGEST:
                    more = {low[:k] + r + low[k + len(x) :] for x, r in RARE_GLYPHS if x in low for k in range(len(low)) if low.startswith(x, k)}
                    out.extend((i, k, 1) for k in {skeleton(m) for m in more} - {s})
            at, skeletons, tiers = zip(*out, strict=True) if out else ([], [], [])
            kept = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(skeletons, pa.string()), pa.array(tiers, pa.int32())], [*batch.schema.names, "skeleton", "tier"])

    return run


def counted_forms(blocks: DataFrame) -> DataFrame:
    """Counts over all blocks: word forms (``what`` 0: trusted, other) and previews without origin (``what`` 1: wraps, long lines)."""
    rows = blocks.select(F.col("name").cast("string"), F.col("origin").cast("string"), F.col("markdown").cast("string"))
    parts = spread(rows).mapInArrow(_count_forms, "what int, key string, a bigint, b bigint")
    return cut(parts.groupBy("what", "key").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))


def spelling(forms: DataFrame) -> DataFrame:
    """``form, options`` of the misread forms among ``forms`` (``form, trusted, other``): the right forms that
    are nearest, as ``support, right``, the best supported first.

    A word is right if it has support enough, is far more frequent than the form and, unless trusted text lacks the
    form, stands in trusted text twenty times as often. A form in capitals gets its right form in capitals. Rare
    misreadings are tried for forms that trusted text lacks.
    """
    form, low = F.col("form"), F.col("low")
    capitals = (form == F.upper("form")) & (form != low)
    begins_upper = F.substring("form", 1, 1) != F.substring("low", 1, 1)
    shown, rank = ~(capitals & (F.char_length("form") > 4)), F.struct(10 * F.col("trusted") + F.col("other"), "form")
    # one exchange: the forms of a word meet
    of_word = Window.partitionBy("low")
    met = forms.withColumn("low", F.lower("form")).withColumns({"t": F.sum("trusted").over(of_word), "o": F.sum("other").over(of_word)})
    support = 10 * F.col("t") + F.col("o")
    right = (
        met.where((support >= LEAST) & low.rlike(r"^\p{L}+$"))
        .groupBy("low", "t", "o")
        .agg(*[F.max_by(F.when(shown & c, form), F.when(shown & c, rank)).alias(n) for n, c in (("usual", F.lit(True)), ("upper", begins_upper), ("lower", ~begins_upper))])
        .where("usual IS NOT NULL")
        .select(F.col("low").alias("k"), F.col("t").alias("kt"), F.col("o").alias("ko"), "usual", "upper", "lower")
        .mapInArrow(_skeletons(rare=False), "k string, kt bigint, ko bigint, usual string, upper string, lower string, skeleton string, tier int")
        .drop("tier")
    )
    asked = met.where("t = 0 OR o > 3 * t").where(~capitals | (F.char_length("form") >= LEAST_CAPITALS)).select("low", "form", "trusted", "t", "o")
    keyed = asked.mapInArrow(_skeletons(rare=True), "low string, form string, trusted bigint, t bigint, o bigint, skeleton string, tier int").where("tier = 0 OR trusted = 0")
    k, t, o = F.col("k"), F.col("t"), F.col("o")
    pairs = keyed.join(right, "skeleton").where((k != low) & (F.col("kt") + F.col("ko") >= TIMES * (t + o)) & (F.col("kt") >= 20 * t))
    pairs = pairs.withColumn("edits", F.levenshtein("low", "k")).where(F.col("edits") <= 1 + F.floor(F.char_length("k") / 3))
    same_case = F.when(begins_upper, F.col("upper")).otherwise(F.col("lower"))
    first = F.when(begins_upper, F.upper(F.substring("k", 1, 1))).otherwise(F.substring("k", 1, 1))
    cased = F.coalesce(same_case, F.concat(first, F.expr("substring(usual, 2)")))
    spelt = F.when(capitals, F.upper("usual")).when(F.substring("low", 1, 1) != F.substring("k", 1, 1), F.col("usual")).otherwise(cased)
    near = pairs.groupBy("form", "tier", "edits").agg(F.sort_array(F.collect_set(F.struct((10 * F.col("kt") + F.col("ko")).alias("support"), spelt.alias("right"))), asc=False).alias("options"))
    return near.groupBy("form").agg(F.min_by("options", F.struct("tier", "edits")).alias("options"))


def _count_neighbours(bits: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = _Maybe(bits).__getitem__
        count: Counter = Counter()

        def flush() -> pa.RecordBatch:
            rows = [(w, side, x, n) for (w, side, x), n in count.items()]
            count.clear()
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.string(), pa.int64()), strict=True)], ["right", "side", "beside", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = _WORD.findall(_JOIN.sub("", text))
                for i, hit in enumerate(map(maybe, words)):
                    if hit:
                        count.update(((words[i], 0, words[i - 1].lower() if i else ""), (words[i], 1, words[i + 1].lower() if i + 1 < len(words) else "")))
                if len(count) > FLUSH:
                    yield flush()
        yield flush()

    return run


def in_context(found: DataFrame, blocks: DataFrame) -> DataFrame:
    """``found`` (``part, options, before, after``) with the ``right`` form of each: of several options the one that
    trusted text has most often between the same neighbours, then the best supported."""
    one = found.where(F.size("options") == 1).withColumn("right", F.col("options")[0]["right"])
    open_ = found.where(F.size("options") > 1).withColumn("_row", F.xxhash64("block_id", "line_no", "start", "part"))
    open_ = open_.select("*", F.explode("options").alias("o"))
    open_ = cut(open_.select(*found.columns, "_row", F.col("o.right").alias("right"), F.col("o.support").alias("support")))
    if open_.isEmpty():
        return one
    bits = form_filter(open_.select(F.col("right").alias("form")).distinct())
    trusted = blocks.where((F.col("origin") == TRUSTED) & F.col("markdown").isNotNull()).select("markdown")
    beside = trusted.mapInArrow(_count_neighbours(bits), "right string, side int, beside string, n bigint").groupBy("right", "side", "beside").agg(F.sum("n").alias("n"))
    asked = open_.select("_row", "right", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("before").alias("beside")), F.struct(F.lit(1).alias("side"), F.col("after").alias("beside")))).alias("a")).select("_row", "right", "a.*")
    seen = asked.join(beside, ["right", "side", "beside"], "left").groupBy("_row", "right").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    best = seen.join(open_.select("_row", "right", "support"), ["_row", "right"]).groupBy("_row").agg(F.max_by("right", F.struct("n", "support", "right")).alias("right"))
    rows = open_.select("_row", *found.columns).dropDuplicates(["_row"])
    return one.unionByName(rows.join(best, "_row").drop("_row"))


def form_filter(forms: DataFrame) -> np.ndarray:
    """Bits of the hashes of all ``form``, in words of 64; it has at most ``MOST_BITS`` bits however many forms there are."""
    bits = LEAST_BITS
    n = forms.count()
    while bits < BITS_EACH * n and bits < MOST_BITS:
        bits *= 2
    h = F.pmod(F.xxhash64("form"), F.lit(bits))
    words = forms.select(h.alias("h")).selectExpr("shiftright(h, 6) AS at", "shiftleft(1L, CAST(h & 63 AS INT)) AS bit").groupBy("at").agg(F.bit_or("bit").alias("word"))
    out, table = np.zeros(bits // 64, np.int64), words.toArrow()
    out[table["at"].to_numpy()] = table["word"].to_numpy()
    return out.view(np.uint64)


class _Maybe(dict):
    """Whether a form may be among the misread ones."""

    def __init__(self, bits: np.ndarray):
        super().__init__()
        self.bits, self.mask = bits, 64 * len(bits) - 1

    def __missing__(self, form: str) -> bool:
        h = xxhash.xxh64_intdigest(form, seed=42) & self.mask  # as Spark's xxhash64
        if len(self) > FLUSH:
            self.clear()
        self[form] = hit = bool(int(self.bits[h >> 6]) >> (h & 63) & 1)
        return hit


def defects(lines: list[str], stamped: list[bool], maybe: Callable[[str], bool]) -> list[tuple[int, str, str, int | None, str | None, str, str]]:
    """``line_no, kind, word, start, part, before, after`` of one page: for ``misread`` a token, its place in the line, the
    part that may be misread and the words beside it."""
    off = [s or is_page_number(x) for x, s in zip(lines, stamped, strict=True)]
    out: list[tuple[int, str, str, int | None, str | None, str, str]] = [(i + 1, "furniture", "", None, None, "", "") for i, f in enumerate(off) if f]
    own = [i for i, f in enumerate(off) if not f and lines[i].strip()]
    if is_junk([lines[i] for i in own]):
        return out
    hits = [w for w in set(_WORD.findall("\n".join([lines[i] for i in own]))) if maybe(w)]
    skip_first = False
    for k, i in enumerate(own):
        line = lines[i]
        head = _GOES_ON.match(line) if skip_first else None
        start, end = (head.end() if head else 0), len(line)
        skip_first = False
        if line.rstrip()[-1:] in HYPHENS and k + 1 < len(own):
            parted, rest = _PARTED.search(line), _GOES_ON.match(lines[own[k + 1]])
            if parted and rest and parted.start() >= start and not _KEPT.match(rest.group(1)):
                out.append((i + 1, "break", parted.group(1) + rest.group(1), None, None, "", ""))
                end, skip_first = parted.start(), True
        if not any(w in line for w in hits):
            continue
        for m in _TOKEN.finditer(line, start, end):
            token = m.group()
            for part in token.split("-"):
                if len(part) > 1 and maybe(part):
                    left, right = _WORD.findall(line[: m.start()]), _WORD.search(line, m.end())
                    out.append((i + 1, "misread", token, m.start(), part, left[-1].lower() if left else "", right.group().lower() if right else ""))
    return out


def _find(model: LineModel, bits: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = _Maybe(bits).__getitem__
        for batch in batches:
            ids, texts, known = (batch.column(i).to_pylist() for i in range(3))
            for a, b in slices(texts):
                t = tokens(texts[a:b], join_hyphens=False)
                stamped, first = (model.stamped(t) | recurs(t, known[a:b])).tolist(), line_starts(t).tolist()
                out = []
                for i in range(a, b):
                    lines = texts[i].split("\n")
                    out.extend((ids[i], *d) for d in defects(lines, stamped[first[i - a] : first[i - a] + len(lines)], maybe))
                cols = list(zip(*out, strict=True)) or [[]] * 8
                types = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int32(), *[pa.string()] * 3)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["block_id", "line_no", "kind", "word", "start", "part", "before", "after"])

    return run


def scanned(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """``block_id, markdown, name`` of the blocks from scans: by origin, or without origin in a preview
    whose lines end within sentences far more often than they are long. A block without origin and preview is none."""
    rows = spread(blocks).where(F.col("block_id").isNotNull() & (F.coalesce(F.col("markdown"), F.lit("")) != "")).select(
        F.col("block_id").cast("bigint").alias("block_id"), F.col("name").alias("_name"), F.col("origin").alias("_origin"), F.col("markdown").cast("string").alias("markdown")
    )
    by_origin = rows.where(F.col("_origin") == SCANNED).select("block_id", "markdown", F.col("_name").alias("name"))
    printed_previews = broadcast_if_small(cut(counts.where((F.col("what") == 1) & (F.col("a") > PRINTED_TIMES * F.col("b"))).select(F.col("key").alias("_name"))))
    unknown = rows.where(F.col("_origin").isNull())
    return by_origin.unionByName(unknown.join(printed_previews, "_name", "left_semi").select("block_id", "markdown", F.col("_name").alias("name")))


def scan_defects(blocks: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """``block_id, line_no, kind, word, start, token`` of each defect of the scanned blocks, once.

    ``token`` is the misread token as it stands, ``start`` its place in the line (from 0). Rows with a null id, or null or empty
    ``markdown``, have no defects; repeated rows of a block count once; an empty table gives
    an empty result. Columns other than ``block_id, name, origin, markdown`` are ignored.
    ``counts`` are those of :func:`counted_forms`, if they are there already.
    """
    read = read_lines(blocks)
    recurring = recurring_lines(read)
    model = fit_on_sample(distinct_lines(read, recurring))
    counts = counted_forms(blocks) if counts is None else counts
    right = cut(spelling(counts.where("what = 0").select(F.col("key").alias("form"), F.col("a").alias("trusted"), F.col("b").alias("other"))))
    scans = with_recurring(scanned(blocks, counts), recurring, "name")
    found = scans.mapInArrow(_find(model, form_filter(right)), "block_id bigint, line_no int, kind string, word string, start int, part string, before string, after string").distinct()
    found = cut(found)
    plain = found.where("kind <> 'misread'").select("block_id", "line_no", "kind", "word", F.lit(None).cast("int").alias("start"), F.lit(None).cast("string").alias("token"))
    misread = (
        in_context(found.where("kind = 'misread'").join(right.withColumnRenamed("form", "part"), "part"), blocks)
        .groupBy("block_id", "line_no", "kind", "start", F.col("word").alias("token"))
        # a token of several parts may be misread in more than one
        .agg(F.map_from_entries(F.collect_set(F.struct("part", "right"))).alias("fixes"))
        .select("block_id", "line_no", "kind", F.array_join(F.transform(F.split("token", "-", -1), lambda x: F.coalesce(F.element_at("fixes", x), x)), "-").alias("word"), "start", "token")
    )
    return plain.unionByName(misread)


def found_defects(blocks: DataFrame) -> DataFrame:
    """``block_id, line_no, kind, word`` of each defect of the scanned blocks."""
    return scan_defects(blocks).select("block_id", "line_no", "kind", "word").distinct()


def _fixed(line: Column, fixes: Column) -> Column:
    """``line`` with each of ``fixes`` (``start, token, word``, in the order of their places) at its place."""
    begin = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(acc: Column, x: Column) -> Column:
        kept = F.substring(line, acc["at"] + 1, x["start"] - acc["at"])
        return F.struct(F.concat(acc["done"], kept, x["word"]).alias("done"), (x["start"] + F.char_length(x["token"])).alias("at"))

    return F.aggregate(fixes, begin, step, lambda acc: F.concat(acc["done"], F.substring(line, acc["at"] + 1, F.char_length(line))))


def repaired(blocks: DataFrame) -> DataFrame:
    """``block_id, paragraphs`` of the scanned blocks: right spellings, no stamped lines, parted words joined,
    lines that go on put together.

    A paragraph ends at a blank line, before a heading, a list item or a table row, and after one. See
    :func:`scan_defects` for odd rows; a scanned block of nothing but furniture has no paragraphs.

    Lines and their defects meet by block, and all that follows keeps that partitioning: texts are shuffled once.
    """
    counts = counted_forms(blocks)
    found = cut(scan_defects(blocks, counts))
    nothing = {"off": F.lit(None).cast("int"), "parted": F.lit(None).cast("string"), "fix": F.lit(None).cast("struct<start:int,token:string,word:string>")}
    lines = scanned(blocks, counts).select("block_id", F.posexplode(F.split("markdown", "\n", -1)).alias("i", "line")).select("block_id", (F.col("i") + 1).alias("line_no"), "line").withColumns(nothing)
    kind = F.col("kind")
    marks = found.select(
        "block_id",
        "line_no",
        F.lit(None).cast("string").alias("line"),
        F.when(kind == "furniture", F.lit(1)).alias("off"),
        F.when(kind == "break", F.col("word")).alias("parted"),
        F.when(kind == "misread", F.struct("start", "token", "word")).alias("fix"),
    )
    met = lines.unionByName(marks).repartition("block_id")
    # a block that was delivered twice has the same lines twice
    x = met.groupBy("block_id", "line_no").agg(F.max("line").alias("line"), F.max("off").alias("off"), F.max("parted").alias("parted"), F.array_sort(F.collect_list("fix")).alias("fixes"))
    x = x.where("off IS NULL AND line IS NOT NULL").withColumn("line", _fixed(F.col("line"), F.col("fixes")))
    page = Window.partitionBy("block_id").orderBy("line_no")
    text = F.trim(F.col("line"))
    mark = r"^(?:\*\*|#{1,6} |\||[-▪•] |\d{1,2}[.)] |[a-z]{1,2}\) |[FA]: |>)"
    own_line = r"^(?:\*\*.*\*\*$|#{1,6} |\||>)"
    # blank lines part paragraphs but not the halves of a word
    x = x.withColumn("t", text).withColumn("blank", F.col("t") == "")
    x = x.withColumn("after_blank", F.coalesce(F.lag("blank").over(page), F.lit(True)))
    x = x.where(~F.col("blank"))
    before = F.lag(F.struct("t", "parted")).over(page)
    x = x.withColumn("before", before)
    starts = F.col("before").isNull() | (F.col("before.parted").isNull() & (F.col("after_blank") | F.col("t").rlike(mark) | F.col("before.t").rlike(own_line)))
    x = x.withColumn("par", F.sum(starts.cast("int")).over(page))
    # a line keeps its own beginning unless it goes on a word; the word as a whole stands at the end of the line before
    head = F.when(F.col("before.parted").isNotNull(), F.regexp_replace("t", r"^[^\p{L}\p{N}\s]*[\p{L}\p{N}-]+", "")).otherwise(F.col("t"))
    whole = F.when(F.col("parted").isNotNull(), F.concat(F.regexp_replace("h", rf"[\p{{L}}\p{{N}}‐-]+[{HYPHENS}]\s*$", ""), F.col("parted"))).otherwise(F.col("h"))
    x = x.withColumn("h", head).withColumn("h", whole)
    # a piece that begins with what followed the word (a stop, say) joins without a blank
    piece = F.when(F.col("before.parted").isNotNull() | (F.col("h") == ""), F.col("h")).otherwise(F.concat(F.lit(" "), F.col("h")))
    pars = x.groupBy("block_id", "par").agg(F.trim(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", piece.alias("p")))), lambda r: r["p"]), "")).alias("text"))
    return pars.groupBy("block_id").agg(F.array_sort(F.collect_list(F.struct("par", "text"))).alias("ps")).select("block_id", F.transform("ps", lambda p: p["text"]).alias("paragraphs"))
