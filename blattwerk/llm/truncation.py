"""Texts that were cut short on their way in, and how often each source cuts.

1. The length of each text is recomputed under the encodings and escapes that a
   field may have been measured in; a length at which a source's texts pile up is a
   hidden storage limit, in the encoding in which most of them pile up. The encoding
   whose lengths equal the announced sizes of a source is the one that it announces in.
2. How words are used is counted over all texts: which frequent ones end no sentence
   and no line, stand in no item of a list, or carry a stop that ends nothing.
3. The ending of each text is inspected with these uses: what was put after a cut is
   taken off, and the rest either ends whole, or within a sentence or word, or leaves
   it open (an item of a list may be whole or cut).
4. What is open is decided by the lengths: a text that falls short of its announced
   size is cut, and so is one that fills a limit if the word at its end begins a longer
   one. A word that hardly ever stands by itself, while longer ones begin with it, is a
   fragment wherever it ends a text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blattwerk.plans import broadcast_if_small, cut, spread

#: Texts that a pile-up holds at least, and how often it must exceed the lengths about it.
PILE, PEAK, ABOUT = 5, 8.0, 100
#: Share of the texts at a limit that end cut or open, and share of its texts that no better limit explains.
CONFIRMED = 0.5
#: A word whose share of all words is at least this is frequent (so at most 10,000 are), if it stands often enough to be judged.
FREQUENT, JUDGED = 1 / 10_000, 300
#: Greatest shares of a word's occurrences: at ends (else it may end something), in lines without a stop (else it is
#: a word of lists); least shares with a stop, and of those that something follows (an abbreviation).
AT_ENDS, IN_ITEMS, WITH_STOP, GOES_ON = 0.002, 0.001, 0.3, 0.8
#: A fragment stands by itself at most this often against longer words that begin with it.
ALONE = 0.001
#: Distinct words that a task holds before it passes them on.
FLUSH = 100_000
#: Letters of the longest word that is looked at.
LONGEST = 60

WHOLE, CUT, OPEN = 0, 1, 2

# Marks that are put after a cut.
_MARKS = re.compile(
    r"(?:\s*(?:…|\.\.\.+|\[\s*(?:…|\.\.\.*|gekürzt|cut|more|mehr)\s*\]|\(\s*(?:…|\.\.\.*|mehr|more|gekürzt|weiter(?:lesen)?|read more)\s*\)?|"
    r"(?:weiterlesen|read more|mehr lesen)|<[^<>]{0,20}>?|&hellip;|\\u2026))+\s*$",
    re.IGNORECASE,
)
# Words after which no sentence and no item ends. These and the next two lists hold only for words that
# the texts have too seldom to be judged by their use.
_LEADING = frozenset(
    "der die das den dem des ein eine einen einem einer eines und oder sowie bzw dass weil wenn ob als im am zum zur vom beim mit nach bei für gegen "
    "über unter zwischen durch ohne kein keine keinen keinem keiner seine seiner ihre ihrer ins sofern soweit sodass "
    "the an of and or to for with from by that which unless because if when where whose".split()
)
# Abbreviations, after whose stop something must follow.
_ABBREVIATIONS = frozenset("abs s art nr rn rdnr vgl bzw gez ff z b ziff lit hs satz no sec cf".split())
# Words that stand in sentences and not in items of lists.
_RUNNING = frozenset(
    "das die den dem ein dass ist sind hat haben wird wurde war und oder nicht wenn weil ob wer bei nach mit gegen zu sich so auf für von im in am an aus vor "
    "nur noch weder sonst denn könnte hätte wäre kann bleibt liegt liegen gilt setzt folgt ohne unter zwischen während über als wie davon somit nennt "
    "the is are has have was were not that which because if neither nor with from into for on at by and or but".split()
)
_ITEM_MARK = re.compile(r"\s*(?:[-*•▪·–+→>]+\s+|\(?\d{1,3}[.)]\s+|\(?[a-z]{1,2}\)\s+|[ivx]+[.)]\s+|[A-Z]:\s+)")
_REFERENCE = re.compile(r"§§?\s*\d+[a-z]?(?:\s+Abs\.\s*\d+)?(?:\s+S\.\s*\d+)?(?:\s+Nr\.\s*\d+)?\s+[A-ZÄÖÜ]\w*[A-ZÄÖÜ]\w*[\s.,;)*\]]*$")
_CELLS = re.compile(r"\t+| {2,}")
_REFERENCE_LINE = re.compile(r"\s*(?:\[\^\w+\]:\s*)?(?:Vgl\.|vgl\.|Siehe|siehe|See|see|Cf\.|§)\s")
_SIGNED = re.compile(r"\s*(?:gez\.|i\.\s*A\.|Notes compiled|Bearbeitet von|signed|Stand:?\s)", re.IGNORECASE)
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
_TAIL_WORD = re.compile(r"([^\W\d_]+(?:-[^\W\d_]+)*)\W*$")
_QUOTE_END = re.compile(r"[“”\"»«’']\s*[.!?]?\s*$")


@dataclass(frozen=True)
class Uses:
    """Words (in lower case) that end no sentence and no item, that stand in no list, and abbreviations."""

    leading: frozenset = _LEADING
    running: frozenset = _RUNNING
    abbreviations: frozenset = _ABBREVIATIONS


def _unclosed(line: str) -> bool:
    opens = line.count("„") + line.count("»")
    return line.count("„") > line.count("“") + line.count("”") or opens == 0 and line.count('"') % 2 == 1


def _item_like(line: str, uses: Uses) -> bool:
    body = _ITEM_MARK.sub("", line, count=1)
    words = [w.lower() for w in _WORD.findall(body)]
    return len(words) <= 10 and uses.running.isdisjoint(words)


def ending(text: str, uses: Uses = Uses()) -> tuple[int, str]:
    """How a text ends (``WHOLE``, ``CUT`` or ``OPEN``) and the word that it ends with ('' if none).

    ``WHOLE`` with a word is a closed ending whose word may yet be a fragment.
    """
    s = text.rstrip()
    if not s:
        return WHOLE, ""
    if s.endswith("�"):
        return CUT, ""
    line = s[s.rfind("\n") + 1 :]
    if _QUOTE_END.search(line) and not _unclosed(line):
        return WHOLE, ""
    rest = _MARKS.sub("", s)
    marked = len(rest) < len(s)
    if not rest:
        return WHOLE, ""
    lines = rest.rsplit("\n", 2)
    line, before = lines[-1], lines[-2] if len(lines) > 1 else ""
    found = _TAIL_WORD.search(line)
    word = found.group(1) if found and len(found.group(1)) <= LONGEST else ""
    low = word.lower()
    bare = line.rstrip("*_` ")
    last = bare[-1:]
    stripped = line.strip()
    if stripped.startswith("|"):
        return (WHOLE if stripped.endswith("|") and not marked else CUT), ""
    if stripped.startswith("**") and stripped.count("**") % 2:
        return CUT, word
    if last in ".!?":
        if last == "." and (low in uses.abbreviations or low in uses.leading) and bare[:-1].lower().endswith(low):
            return CUT, word
        if re.search(r"(?:§|\bAbs\.|\bS\.|\bArt\.)\s*\d+[a-z]?\.$", bare):
            return CUT, ""
        return WHOLE, word
    if _unclosed(line):
        return CUT, word
    if low in uses.leading and bare.lower().endswith(low):
        return CUT, word
    if last in ")]" and marked is False and bare.count("(") <= bare.count(")") and bare.count("[") <= bare.count("]"):
        return OPEN if not _item_like(line, uses) else WHOLE, ""
    cells = _CELLS.split(stripped)
    if len(cells) > 1 and not marked and _item_like(line, uses):  # a table without rules: its last cell decides
        if "§" in cells[-1]:
            return (WHOLE if _REFERENCE.search(cells[-1]) else CUT), ""
        return (OPEN if cells[-1][-1:].isalpha() else WHOLE), word
    if _REFERENCE_LINE.match(line) or "§" in line[-45:] and _item_like(line, uses):
        return (WHOLE if _REFERENCE.search(line) and not marked else CUT), ("" if _REFERENCE.search(line) else word)
    if stripped.startswith("**") and not marked:
        return (OPEN if stripped.endswith("**") and len(stripped) > 4 else CUT), word
    if stripped.startswith("#"):
        return (CUT if marked else OPEN), word
    if _SIGNED.match(line):
        return (CUT if marked else WHOLE), word
    if marked:
        return CUT, word
    if not _item_like(line, uses):
        return CUT, word
    listed = bool(_ITEM_MARK.match(line)) or "\t" in line or "   " in line or "  " in line.strip()
    in_list = bool(before.strip()) and _item_like(before, uses) and before.rstrip()[-1:] not in ".!?" or before.rstrip()[-1:] in ";," and bool(before.strip())
    if not listed and not in_list and not (before.strip() and _item_like(before, uses)):
        return CUT, word
    return (OPEN if last.isalpha() else WHOLE), word


def _endings(uses: Uses) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(3).to_pylist()]
            sizes = list(zip(*map(lengths, texts), strict=True)) or [()] * len(ENCODINGS)
            ends = [ending(x, uses) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), *(pa.array(n, pa.int64()) for n in sizes), pa.array([e[0] for e in ends], pa.int32()), pa.array([e[1] for e in ends], pa.string())],
                ["doc_id", "source", "declared", *ENCODINGS, "how", "word"],
            )

    return run


_PIECE = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*|\d+|[.!?:;\n]")
_ENDS = frozenset(".!?:;\n")


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, ...] = tuple(Counter() for _ in range(5))
    every, ends, items, stops, on = counts

    def flush() -> pa.RecordBatch:
        words = [w for w in every if w[0].isalpha() and len(w) <= LONGEST]
        cols = [pa.array([c[w] for w in words], pa.int64()) for c in counts]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *cols], ["word", "n", "ends", "items", "stops", "goes_on"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            p = _PIECE.findall(text or "")
            while p and not p[-1][0].isalpha():
                p.pop()
            if p:
                p.pop()  # the last word may be cut
            every.update(p)
            marks = [i for i, x in enumerate(p) if x in _ENDS]
            ends.update([p[i - 1] for i in marks if i])
            stopped = [(p[i - 1], p[i + 1]) for i in marks if i and p[i] == "." and i + 1 < len(p)]
            stops.update([a for a, _ in stopped])
            on.update([a for a, c in stopped if c[0].isdigit() or c[0].islower()])
            for line in (text or "").split("\n")[:-1]:
                line = line.rstrip()
                if line and line[-1] not in '.!?:;,"“”':
                    items.update(_WORD.findall(line))
        if len(every) > FLUSH:
            yield flush()
    yield flush()


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n, ends, items, stops, goes_on`` over all ``texts`` (one column), the last word of each left out: how often a word
    stands, stands before a mark or line end, in a line without a stop, before a stop, and before one that something goes on after."""
    parts = spread(texts).mapInArrow(_words, "word string, n bigint, ends bigint, items bigint, stops bigint, goes_on bigint")
    return cut(parts.groupBy("word").agg(*[F.sum(c).alias(c) for c in parts.columns[1:]]))


def word_uses(words: DataFrame) -> Uses:
    """How the frequent words are used; the others are judged by the fixed lists."""
    total = words.agg(F.sum("n")).first()[0] or 0
    low = words.groupBy(F.lower("word").alias("word")).agg(*[F.sum(c).alias(c) for c in words.columns[1:]])
    rows = low.where(F.col("n") >= max(JUDGED, FREQUENT * total)).collect()
    judged = {r["word"] for r in rows}

    def learned(fixed: frozenset, holds: Callable) -> frozenset:
        return frozenset(r["word"] for r in rows if holds(r)) | (fixed - judged)

    return Uses(
        learned(_LEADING, lambda r: r["ends"] <= AT_ENDS * r["n"]),
        learned(_RUNNING, lambda r: r["items"] <= IN_ITEMS * r["n"]),
        learned(_ABBREVIATIONS, lambda r: r["stops"] >= WITH_STOP * r["n"] and r["goes_on"] >= GOES_ON * r["stops"]),
    )


ENCODINGS = (
    "chars", "chars_crlf", "utf8", "utf8_crlf", "utf16", "html", "html_utf8", "entities", "numeric_entities", "json", "json_utf8", "json_ascii",
)


def lengths(text: str) -> tuple[int, ...]:
    """Lengths of a text under the encodings, escapes and line ends that a field may count, as ``ENCODINGS``."""
    n = text.count
    chars, utf8 = len(text), len(text.encode("utf-8", "replace"))
    other = chars - len(text.encode("ascii", "ignore"))
    lf, quotes = n("\n"), n('"')
    marks = 4 * n("&") + 3 * (n("<") + n(">")) + 5 * quotes
    json = lf + quotes + n("\\") + n("\t") + n("\r")
    named = 5 * sum(map(n, "äöüÄÖÜ")) + 6 * n("ß") + 5 * sum(map(n, "§–€„“")) if other else 0
    wide = sum(map(n, "–€„“…•▪→")) if other else 0
    units = len(text.encode("utf-16-le", "replace"))
    return (
        chars, chars + lf, utf8, utf8 + lf, units, chars + marks, utf8 + marks, chars + marks + named,
        chars + 5 * other + wide, chars + json, utf8 + json, chars + json + 5 * other,
    )


def _stacked(rows: DataFrame, *keep: str) -> DataFrame:
    pairs = F.explode(F.map_from_arrays(F.array(*[F.lit(e) for e in ENCODINGS]), F.array(*[F.col(e) for e in ENCODINGS])))
    return rows.select(*keep, pairs.alias("encoding", "length"))


def storage_limits(rows: DataFrame) -> DataFrame:
    """``source, encoding, length, n, cut_share`` of the hidden limits; ``rows`` has ``doc_id, source, how`` and a column per encoding.

    Texts that fill a limit in one encoding pile up in similar ones as well, so a text counts for the greatest of
    its piles, and a pile is a limit if most of its texts count for it.
    """
    long = _stacked(rows.where(F.col("chars") > 0), "doc_id", "source", "how")
    of = ["source", "encoding", "length"]
    piles = long.groupBy(*of).agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("how") != WHOLE).cast("double")).alias("cut_share"))
    near = Window.partitionBy("source", "encoding").orderBy("length").rangeBetween(-ABOUT, ABOUT)
    about = (F.sum("n").over(near) - F.col("n")) / (2.0 * ABOUT)
    found = cut(
        piles.withColumn("about", about)
        .where((F.col("n") >= PILE) & (F.col("n") >= PEAK * F.greatest(F.col("about"), F.lit(0.1))) & (F.col("cut_share") >= CONFIRMED))
        .select(*of, "n", "cut_share")
    )
    order = F.struct(F.col("n").alias("n"), *[(F.col("encoding") == e).alias(f"is_{e}") for e in ENCODINGS], F.col("length").alias("length"))
    best = long.join(broadcast_if_small(found), of).groupBy("doc_id").agg(F.max_by(F.struct(*of), order).alias("best"))
    counted = best.groupBy(*[F.col(f"best.{c}").alias(c) for c in of]).agg(F.count(F.lit(1)).alias("own"))
    return found.join(counted, of).where(F.col("own") >= CONFIRMED * F.col("n")).select(*of, "n", "cut_share")


def announced_in(rows: DataFrame) -> DataFrame:
    """``source, encoding`` in which most of a source's announced sizes equal the lengths."""
    long = _stacked(rows.where(F.col("declared").isNotNull()), "source", "declared")
    share = long.groupBy("source", "encoding").agg(F.avg((F.col("length") == F.col("declared")).cast("double")).alias("share"), F.count(F.lit(1)).alias("n"))
    best = share.where((F.col("share") >= 0.5) & (F.col("n") >= PILE)).groupBy("source").agg(F.max_by("encoding", F.struct("share", "encoding")).alias("encoding"))
    return best


#: Endings of inflection; a word that goes on by one of them is no longer word.
INFLECTION = ("e", "en", "er", "es", "em", "s", "n", "r", "m", "ens", "ern")


def word_beginnings(rows: DataFrame, words: DataFrame) -> DataFrame:
    """``word, fragment`` of the words among ``rows.word`` that begin a longer word (by more than an inflection).

    In the order of the words, those that begin with a word follow on it, so their number is the difference of two running
    sums; the words are parted by their first two letters, and single letters are summed apart. A fragment stands by
    itself at most ``ALONE`` times as often as longer words do.
    """
    asked = cut(rows.where(F.col("word") != "").select("word").distinct())
    own = asked.select("word", F.explode(F.array(F.lit(""), *[F.lit(e) for e in INFLECTION])).alias("end")).withColumn("form", F.concat("word", "end"))
    forms = own.join(words.select(F.col("word").alias("form"), "n"), "form").groupBy("word").agg(F.sum(F.when(F.col("end") == "", F.col("n")).otherwise(0)).alias("alone"), F.sum(F.when(F.char_length("form") > 3, F.col("n")).otherwise(0)).alias("forms"))
    two = F.substring("word", 1, 2)
    marks = asked.where(F.char_length("word") > 1).select(two.alias("part"), F.explode(F.array(F.struct(F.col("word").alias("at"), F.lit(-1).alias("sign")), F.struct(F.concat("word", F.lit("\U0010ffff")).alias("at"), F.lit(1).alias("sign")))).alias("m"), "word")
    line = words.where(F.char_length("word") > 3).select(two.alias("part"), F.col("word").alias("at"), F.lit(0).alias("sign"), "n", F.lit(None).cast("string").alias("word"))
    line = line.unionByName(marks.select("part", "m.at", "m.sign", F.lit(0).cast("bigint").alias("n"), "word"))
    so_far = F.sum("n").over(Window.partitionBy("part").orderBy("at", "sign").rowsBetween(Window.unboundedPreceding, 0))
    begun = line.withColumn("so_far", so_far).where("sign <> 0").groupBy("word").agg(F.sum(F.col("sign") * F.col("so_far")).alias("begun"))
    single = asked.where(F.char_length("word") == 1).join(words.where(F.char_length("word") > 3).groupBy(F.substring("word", 1, 1).alias("word")).agg(F.sum("n").alias("begun")), "word")
    counted = begun.unionByName(single).join(forms, "word", "left").select("word", "begun", F.coalesce("alone", F.lit(0)).alias("alone"), F.coalesce("forms", F.lit(0)).alias("forms"))
    longer = F.col("begun") - F.col("forms")
    return counted.where(longer > 0).select("word", (F.col("alone") <= ALONE * longer).alias("fragment"))


def judged(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, source, how, word, at_limit, short, fragment, begins, truncated`` of each document.

    ``source`` is trimmed and in lower case, null becomes ''. Rows with a null id are left out; a
    null or empty text is whole. Repeated rows come out as often as they go in; an empty table
    gives an empty result. Columns other than the id, the text, ``source`` and ``declared_bytes``
    are ignored.
    """
    rows = documents.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.lower(F.trim("source")), F.lit("")).alias("source"),
        F.col("declared_bytes").cast("bigint").alias("declared"),
        F.col(text_col).cast("string").alias("text"),
    )
    schema = "doc_id bigint, source string, declared bigint, " + ", ".join(f"{e} bigint" for e in ENCODINGS) + ", how int, word string"
    words = word_counts(documents.select(F.col(text_col).cast("string")))
    ends = cut(spread(rows).mapInArrow(_endings(word_uses(words)), schema))
    begun = broadcast_if_small(cut(word_beginnings(ends, words)).withColumn("begins", F.lit(True)))
    limits = storage_limits(ends).groupBy("source").agg(F.collect_set(F.struct("encoding", "length")).alias("limits"))
    per_source = broadcast_if_small(cut(limits.join(announced_in(ends), "source", "full")))
    own = F.create_map(*[x for e in ENCODINGS for x in (F.lit(e), F.col(e))])
    fills = F.exists(F.coalesce("limits", F.array().cast("array<struct<encoding:string,length:bigint>>")), lambda x: F.element_at(own, x["encoding"]) == x["length"])
    known = ends.join(per_source, "source", "left").join(begun, "word", "left")
    return known.select(
        "doc_id",
        "source",
        "how",
        "word",
        fills.alias("at_limit"),
        F.coalesce(F.col("declared") > F.element_at(own, F.col("encoding")), F.lit(False)).alias("short"),
        F.coalesce("fragment", F.lit(False)).alias("fragment"),
        F.coalesce("begins", F.lit(False)).alias("begins"),
    ).withColumn("truncated", (F.col("how") == CUT) | F.col("fragment") | ((F.col("how") == OPEN) & (F.col("short") | (F.col("at_limit") & F.col("begins")))))


def truncated_documents(documents: DataFrame) -> DataFrame:
    """``doc_id`` of the documents whose text was cut inside a word or sentence."""
    return judged(documents).where("truncated").select("doc_id").distinct()


def truncation_rates(documents: DataFrame) -> DataFrame:
    """``source, documents, truncated, share`` and what the cut ones show: ``at_limit``, ``short`` of the announced size, a
    ``fragment``, or nothing but their ending (``ending_only``); ``by_length`` are those that a limit or size decides."""
    n = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    t, sized = F.col("truncated"), F.col("at_limit") | F.col("short")
    return (
        judged(documents)
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("documents"),
            n(t).alias("truncated"),
            n(t & F.col("at_limit")).alias("at_limit"),
            n(t & F.col("short")).alias("short"),
            n(t & F.col("fragment")).alias("fragment"),
            n(t & sized & (F.col("how") != CUT) & ~F.col("fragment")).alias("by_length"),
            n(t & ~sized & ~F.col("fragment")).alias("ending_only"),
        )
        .withColumn("share", F.col("truncated") / F.col("documents"))
    )
