"""Queries of the readers: the tables are written in each format and read back, so SQL over the tables says what must come out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blattwerk.functions import measures as M
from blattwerk.operators import documents as D
from blattwerk.operators import review as R
from blattwerk.queries.joins import _texts
from blattwerk.queries.lines import BOXED
from blattwerk.queries.quality import BLOCKS
from blattwerk.queries.registry import register
from blattwerk.queries.review import _STATES, _STATUS
from blattwerk.sources import parse
from blattwerk.sources.pages import blocks
from blattwerk.sources.tables import table

_BOX = ("x0", "y0", "x1", "y1")
#: Lines that no blank in front or behind makes another text of, in their order.
_ORDERED = f"{BOXED}, o AS (SELECT *, CAST(row_number() OVER (PARTITION BY block_id ORDER BY seq) - 1 AS INT) AS i FROM boxed)"


def _written(s: SparkSession, d: str, *line: object) -> DataFrame:
    """``block_id, t``: the boxed lines of each block in a format, ``line`` by line."""
    one = F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in line])
    g = _texts(s, d).groupBy("block_id").agg(F.array_sort(F.collect_list(F.struct("seq", one.alias("l")))).alias("ls"))
    return g.select("block_id", F.array_join(F.transform("ls", lambda x: x["l"]), "\n").alias("t"))


def _tagged(s: SparkSession, d: str) -> DataFrame:
    tags = [x for c in ("x0", "y0", "x1", "y0", "x1", "y1", "x0", "y1") for x in ("<|LOC_", F.col(c).cast("string"), "|>")]
    return parse.tagged_lines(_written(s, d, *tags, F.col("text")), "block_id", "t").select("block_id", "seq", "text", *[F.col(f"box.{c}").alias(c) for c in _BOX])


register("tagged_lines", _tagged, f"WITH {_ORDERED} SELECT block_id, i AS seq, trim(text) AS text, x0, y0, x1, y1 FROM o")


def _listed(s: SparkSession, d: str) -> DataFrame:
    v = [F.col(c).cast("double").cast("string") for c in _BOX]
    t = _written(s, d, '<word xMin="', v[0], '" yMin="', v[1], '" xMax="', v[2], '" yMax="', v[3], '">x</word>')
    return parse.word_boxes(t.withColumn("t", F.concat(F.lit('<page width="595.5" height="842.0">\n'), "t")), "block_id", "t")


register("word_boxes", _listed, f"WITH {_ORDERED} SELECT block_id, i AS seq, 595.5::DOUBLE AS page_width, x0::DOUBLE AS x_min, y0::DOUBLE AS y_min, x1::DOUBLE AS x_max, y1::DOUBLE AS y_max FROM o")


def _fed(s: SparkSession, d: str) -> DataFrame:
    b = blocks(s, d).where("name IS NOT NULL AND markdown IS NOT NULL").withColumn("part", F.floor((F.col("page_no") - 1) / 2000))
    g = b.groupBy("name", "part").agg(F.array_sort(F.collect_list(F.struct("page_no", "block_id", "markdown"))).alias("ps"))
    return parse.form_feed_pages(g.select("name", F.array_join(F.transform("ps", lambda p: p["markdown"]), "\f").alias("t")), "name", "t").select("name", "page_no", F.md5("text").alias("text_md5"))


register(
    "form_feed_pages",
    _fed,
    f"""WITH {BLOCKS}, p AS (SELECT name, (page_no - 1) // 2000 AS part, markdown, row_number() OVER w AS i, count(*) OVER (PARTITION BY name, (page_no - 1) // 2000) AS n FROM blocks WHERE name IS NOT NULL AND markdown IS NOT NULL WINDOW w AS (PARTITION BY name, (page_no - 1) // 2000 ORDER BY page_no, block_id))
SELECT name, CAST(i AS INT) AS page_no, md5(markdown) AS text_md5 FROM p WHERE i < n OR regexp_matches(markdown, '[^\\t\\n\\f\\r\\v ]')""",
)


def _heads(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "preview").where("name IS NOT NULL").select("name", F.col("name").alias("title"), "source_pdf", "pages")
    h = v.select("name", parse.head(D.head(["title", "source_pdf", "pages"])).alias("h"))
    return h.select("name", *[F.try_element_at("h", F.lit(k)).alias(c) for k, c in (("titel", "title"), ("quelle-pdf", "source"), ("seiten", "pages"), ("vorschau-format", "version"))])


register(
    "flat_heads",
    _heads,
    "SELECT name, trim(name) AS title, coalesce(trim(replace(replace(source_pdf, '\\', '\\\\'), '\"', '\\\"')), 'null') AS source, coalesce(CAST(pages AS VARCHAR), 'null') AS pages, '1' AS version FROM preview WHERE name IS NOT NULL",
)
register(
    "dictionary_words",
    # every word as a line of a list: flags behind even ones, notes behind the others, and a comment for each
    lambda s, d: parse.dictionary_words(table(s, d, "vocab").where("word IS NOT NULL").select(F.explode(F.array(F.concat("word", F.when(F.char_length("word") % 2 == 0, "/ES").otherwise("\tpo:noun")), F.concat(F.lit("# "), "word"), F.lit("3300"))).alias("value"))),
    "SELECT DISTINCT lower(word) AS word FROM vocab WHERE trim(word) <> '' AND NOT starts_with(word, '#') AND NOT regexp_full_match(word, '[0-9]+')",
)


def _maps(s: SparkSession, d: str) -> DataFrame:
    page = F.struct(F.col("seq").alias("orig"), F.lit("split").alias("type"), F.when(F.col("x0") < 500, "left").otherwise("right").alias("side"), F.lit(500.5).alias("split_x"), F.col("x1").cast("double").alias("w"), F.col("y1").cast("double").alias("h"))
    g = _texts(s, d).groupBy("block_id").agg(F.to_json(F.struct(F.array_sort(F.collect_list(page)).alias("pages"), F.lit("a.pdf").alias("source"))).alias("j"))
    m = g.select("block_id", parse.split_map(F.col("j")).alias("m"))
    return m.select("block_id", F.col("m.source").alias("source"), F.explode("m.pages").alias("p")).select("block_id", "source", "p.orig", "p.side", "p.split_x", "p.w", "p.h")


register("split_maps", _maps, f"WITH {BOXED} SELECT block_id, 'a.pdf' AS source, seq AS orig, CASE WHEN x0 < 500 THEN 'left' ELSE 'right' END AS side, 500.5::DOUBLE AS split_x, x1::DOUBLE AS w, y1::DOUBLE AS h FROM boxed")
register(
    "source_links",
    lambda s, d: table(s, d, "preview").select("name", parse.source_link(F.concat(F.lit("Titel\nquelle: [["), "source_pdf", F.lit("|Original]]\n"), F.coalesce("preamble", F.lit("")))).alias("link")),
    "SELECT name, trim(source_pdf) AS link FROM preview",
)
register(
    "strict_selection",
    lambda s, d: table(s, d, "preview").where("pages >= 2").select("name", F.explode(parse.page_selection(F.lit("2, 1-2"), F.col("pages"), strict=True)).alias("page_no")),
    "SELECT name, unnest([1, 2]) AS page_no FROM preview WHERE pages >= 2",
)
register(
    "expected_chars",
    lambda s, d: blocks(s, d).select("block_id", *_expected()),
    f"""WITH {BLOCKS}, m AS (SELECT block_id, CAST(length(coalesce(markdown, '')) AS DOUBLE) AS c, CAST(strlen(coalesce(markdown, '')) AS DOUBLE) * 40 AS ink, origin FROM blocks)
SELECT block_id, round(ink * CASE WHEN c >= 400 AND ink > 0 THEN c / ink ELSE 0.0188 END, 6) AS expected, coalesce(origin = 'ocr', false) OR c < 100 AS scanned FROM m""",
)
register(
    "status_folders",
    lambda s, d: R.latest_states(table(s, d, "manifest")).select("name", R.folder_of(R.canonical_status(F.col("status")), "offen", "akzeptiert", "abgelehnt").alias("folder")),
    f"""WITH {_STATES}, c AS (SELECT name, {_STATUS.format(c="status")} AS s FROM states) SELECT name, CASE s WHEN 'accepted' THEN 'akzeptiert' WHEN 'rejected' THEN 'abgelehnt' WHEN 'open' THEN 'offen' WHEN 're-created' THEN 'offen' END AS folder FROM c""",
)


def _expected() -> list:
    chars = F.char_length(F.coalesce("markdown", F.lit(""))).cast("double")
    ink = F.octet_length(F.coalesce("markdown", F.lit(""))).cast("double") * 40
    ratio = F.when(F.coalesce(F.col("origin") == "ocr", F.lit(False)), 0.8).otherwise(0.1)
    return [F.round(M.expected_chars(ink, chars, ink), 6).alias("expected"), M.scanned_page(ratio, chars).alias("scanned")]
