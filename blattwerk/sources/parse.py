"""Readers of the texts that pages come in: previews with page markers, heads, tagged lines, word boxes,
form-feed pages, word lists, split maps and progress events. Everything is column expressions over one text
column, so a corpus of files is read with ``spark.read`` and parsed in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARKER = r"(?i)^%%\s*(?:S\.|p\.)\s*\d+\s*(?:\|.*?)?\s*%%\s*$"
SOURCE_LINK = r"(?i)^(?:Source|Quelle):\s*\[\[([^\]|]+)(?:\|[^\]]*)?\]\]\s*$"
FENCE = r"^\s{0,3}(`{3,}|~{3,})"

PROGRESS = T.StructType(
    [
        T.StructField(n, t)
        for n, t in (
            ("typ", T.StringType()), ("type", T.StringType()), ("nr", T.IntegerType()), ("von", T.IntegerType()), ("of", T.IntegerType()), ("seiten", T.IntegerType()),
            ("sekunden", T.DoubleType()), ("seconds", T.DoubleType()), ("herkunft", T.StringType()), ("origin", T.StringType()), ("entgleist", T.BooleanType()), ("derailed", T.BooleanType()), ("grund", T.StringType()),
        )
    ]
)
SPLIT_MAP = "struct<pages:array<struct<orig:int,type:string,side:string,split_x:double,w:double,h:double>>,source:string>"


def head_lines(text: Column) -> Column:
    """The lines of a text's head between its first line ``---`` and the next; null without a closed head."""
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.regexp_replace(x, r"\s+$", ""))
    end = F.array_position(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), F.lit("---"))
    return F.when((F.trim(F.get(lines, F.lit(0))) == "---") & (end > 0), F.slice(lines, F.lit(2), F.greatest(end - 1, F.lit(0)).cast("int")))


def head(text: Column) -> Column:
    """A text's head as a map: flat ``key: value``, one pair of quotes taken off, the last of equal keys holds."""
    rows = F.filter(F.coalesce(head_lines(text), F.array().cast("array<string>")), lambda x: x.contains(":") & ~F.trim(x).startswith("#"))
    key = lambda x: F.trim(F.substring_index(x, ":", 1))
    val = lambda x: F.regexp_replace(F.trim(F.regexp_replace(x, r"^[^:]*:", "")), r"""^(["'])(.*)\1$""", "$2")
    last = F.filter(rows, lambda x, i: ~F.exists(F.slice(rows, i + 2, F.size(rows)), lambda y: key(y) == key(x)))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(key(x).alias("k"), val(x).alias("v"))))


def preview_lines(files: DataFrame, key: str, text: str) -> DataFrame:
    """``key, i, line, fenced, block`` of the lines after a preview's head.

    ``fenced`` is whether a line stands within a code fence (a fold over the lines: only a fence of the same
    character closes one); ``block`` counts page markers outside fences, 0 is the preamble.
    """
    body_at = F.when(head_lines(F.col(text)).isNotNull(), F.size(head_lines(F.col(text))) + 2).otherwise(F.lit(0))
    lines = F.split(F.col(text), "\n", -1)
    rest = F.slice(lines, body_at + 1, F.greatest(F.size(lines) - body_at, F.lit(0)))
    start = F.struct(F.lit("").alias("open"), F.lit(0).alias("block"), F.array().cast("array<struct<line:string,fenced:boolean,marker:boolean,block:int>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        mark = F.substring(F.regexp_extract(x, FENCE, 1), 1, 1)
        now = F.when((s["open"] == "") & (mark != ""), mark).when((s["open"] != "") & (mark == s["open"]), F.lit("")).otherwise(s["open"])
        marker = (now == "") & x.rlike(MARKER)
        block = s["block"] + marker.cast("int")
        return F.struct(now.alias("open"), block.alias("block"), F.concat(s["out"], F.array(F.struct(x.alias("line"), (now != "").alias("fenced"), marker.alias("marker"), block.alias("block")))).alias("out"))

    folded = F.aggregate(rest, start, step, lambda s: s["out"])
    return files.select(key, F.posexplode(folded).alias("i", "r")).select(key, "i", "r.line", "r.fenced", "r.marker", "r.block")


def preview_blocks(files: DataFrame, key: str, text: str) -> DataFrame:
    """``key, block, marker_line, markdown`` of the page blocks of previews; block 0 is the preamble without its source link."""
    from blattwerk.operators.review import marker_fields

    x = preview_lines(files, key, text).where(~((F.col("block") == 0) & F.col("line").rlike(SOURCE_LINK)))
    g = x.groupBy(key, "block").agg(
        F.max(F.when(F.col("marker"), F.col("line"))).alias("marker_line"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("marker"), F.struct("i", "line")))), lambda r: r["line"]), "\n").alias("markdown"),
    )
    trimmed = F.regexp_replace(F.col("markdown"), r"^\s+|\s+$", "")
    return g.select(key, "block", "marker_line", trimmed.alias("markdown"), *[c.alias(k) for k, c in marker_fields(F.coalesce("marker_line", F.lit(""))).items()])


def plain_pages(files: DataFrame, key: str, text: str) -> DataFrame:
    """``key, page, markdown`` by page markers alone, fences or not."""
    numbers = F.regexp_extract_all(text, F.lit(r"(?:%% S\. (\d+)(?: \|[^\n]*)?%%\n*)"), F.lit(1))
    bodies = F.split(text, r"%% S\. \d+(?: \|[^\n]*)?%%\n*", -1)
    pairs = F.transform(numbers, lambda n, i: F.struct(n.cast("int").alias("page"), F.get(bodies, i + 1).alias("markdown")))
    return files.select(key, F.explode(pairs).alias("p")).select(key, "p.page", "p.markdown")


def source_link(text: Column) -> Column:
    links = F.filter(F.split(text, "\n"), lambda x: x.rlike(SOURCE_LINK))
    return F.when(F.size(links) > 0, F.trim(F.regexp_extract(F.get(links, F.lit(0)), SOURCE_LINK, 1)))


def tagged_lines(files: DataFrame, key: str, text: str) -> DataFrame:
    """``key, seq, text, box`` of model output: eight place tags or more make a box of their extremes, blank lines go."""
    raw = files.select(key, F.posexplode(F.split(text, r"\r?\n")).alias("seq", "raw"))
    at = F.transform(F.regexp_extract_all("raw", F.lit(r"<\|LOC_(\d+)\|>"), F.lit(1)), lambda v: v.cast("int"))
    xs, ys = F.filter(at, lambda v, i: i % 2 == 0), F.filter(at, lambda v, i: i % 2 == 1)
    box = F.when(F.size(at) >= 8, F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1")))
    return raw.select(key, "seq", F.trim(F.regexp_replace("raw", r"<\|LOC_\d+\|>", "")).alias("text"), box.alias("box")).where("text <> ''")


def word_boxes(files: DataFrame, key: str, text: str) -> DataFrame:
    """``key, seq, page_width, x_min, y_min, x_max, y_max`` of the words in a bounding-box listing of one page."""
    num = r'="([^"]+)"'
    width = F.regexp_extract(text, rf"<page width{num}", 1).try_cast("double")
    words = F.regexp_extract_all(text, F.lit(r'(<word xMin="[^"]+" yMin="[^"]+" xMax="[^"]+" yMax="[^"]+")'), F.lit(1))
    w = files.select(key, width.alias("page_width"), F.posexplode(words).alias("seq", "w"))
    return w.select(key, "seq", "page_width", *[F.regexp_extract("w", rf"{a}{num}", 1).try_cast("double").alias(b) for a, b in (("xMin", "x_min"), ("yMin", "y_min"), ("xMax", "x_max"), ("yMax", "y_max"))])


def form_feed_pages(files: DataFrame, key: str, text: str) -> DataFrame:
    """``key, page_no, text`` of pages parted by form feeds; one blank page at the end goes."""
    pages = F.split(text, "\f", -1)
    last_blank = F.trim(F.regexp_replace(F.element_at(pages, -1), r"\s+", " ")) == ""
    kept = F.when(last_blank, F.slice(pages, F.lit(1), F.size(pages) - 1)).otherwise(pages)
    return files.select(key, F.posexplode(kept).alias("i", "text")).select(key, (F.col("i") + 1).alias("page_no"), "text")


def dictionary_words(lines: DataFrame, col: str = "value") -> DataFrame:
    """Distinct lower-case words of a word list: flags after ``/`` and notes after a tab go, so do comments and counts."""
    w = F.trim(F.substring_index(F.substring_index(F.col(col), "\t", 1), "/", 1))
    return lines.select(F.lower(w).alias("word")).where((F.col("word") != "") & ~F.col("word").startswith("#") & ~F.col("word").rlike(r"^\d+$")).distinct()


def split_map(json: Column) -> Column:
    return F.from_json(json, SPLIT_MAP)


def progress(json: Column) -> Column:
    """A progress event under today's and old field names; null for what is none."""
    e = F.from_json(json, PROGRESS)
    kind = F.lower(F.coalesce(e["typ"], e["type"]))
    kind = F.when(kind == "start", "start").when(kind.isin("seite", "page"), "page").when(kind.isin("fertig", "done"), "done")
    return F.when(
        kind.isNotNull(),
        F.struct(
            kind.alias("kind"), e["nr"].alias("nr"), F.coalesce(e["von"], e["of"], e["seiten"]).alias("of"), F.coalesce(e["sekunden"], e["seconds"]).alias("seconds"),
            F.coalesce(e["herkunft"], e["origin"]).alias("origin"), F.coalesce(e["entgleist"], e["derailed"], F.lit(False)).alias("derailed"), e["grund"].alias("reason"),
        ),
    )


def page_selection(text: Column, last: Column, strict: bool) -> Column:
    """The pages of a selection like ``1,3-5``, sorted. A strict one raises at a bad part or a page that is not there;
    a lenient one drops pages outside 1 to ``last``."""
    items = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    lo = lambda x: F.regexp_extract(x, r"^(\d+)", 1).try_cast("int")
    hi = lambda x: F.coalesce(F.regexp_extract(x, r"^\d+\s*-\s*(\d+)$", 1).try_cast("int"), lo(x))
    good = lambda x: x.rlike(r"^\d+(?:\s*-\s*\d+)?$") & (lo(x) <= hi(x)) & (lo(x) >= 1)
    pages = lambda xs: F.array_sort(F.array_distinct(F.flatten(F.transform(xs, lambda x: F.sequence(lo(x), hi(x))))))
    if strict:
        bad = F.exists(items, lambda x: ~good(x)) | F.exists(items, lambda x: good(x) & (hi(x) > last))
        return F.when(bad, F.raise_error(F.concat(F.lit("no such pages: "), text)).cast("array<int>")).otherwise(pages(items))
    fits = F.filter(items, lambda x: x.rlike(r"^\d+(?:\s*-\s*\d+)?$") & (lo(x) <= hi(x)))
    return F.filter(pages(fits), lambda p: p.between(F.lit(1), last))
