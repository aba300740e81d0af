"""Documents put together from pages, and taken apart again without loss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fields of a head in their order: key, column, and whether it is left out when 0 or null.
HEAD = (
    ("titel", "title", False), ("quelle-pdf", "source_pdf", False), ("seiten", "pages", False), ("seiten-textlayer", "pages_textlayer", False), ("seiten-ocr", "pages_ocr", False),
    ("seiten-diagramm", "pages_diagram", True), ("seiten-entgleist", "pages_derailed", True), ("woerter-verdaechtig", "words_suspect", True), ("woerter-korrigiert", "words_corrected", True),
    ("abgebrochen", "aborted", True), ("ocr-modell", "ocr_model", True), ("ocr-datum", "ocr_date", False), ("ocr-zeitpunkt", "ocr_timestamp", False),
)


def head(columns: list[str]) -> Column:
    """The head of a document from the columns that are there; optional fields only where they say something."""
    rows = []
    for key, col, optional in HEAD:
        if col not in columns:
            continue
        v = F.col(col).cast("string")
        v = F.concat(F.lit('"'), F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')) if col == "source_pdf" else v
        row = F.concat(F.lit(f"{key}: "), F.coalesce(v, F.lit("null")))
        rows.append(F.when(F.col(col).isNotNull() & ~F.col(col).cast("string").isin("0", ""), row) if optional else row)
    return F.concat(F.concat_ws("\n", F.lit("---"), *rows, F.lit("vorschau-format: 1"), F.lit("---")), F.lit("\n"))


def marker(page: Column, origin: Column, layout: Column) -> Column:
    return F.concat(F.concat_ws(" | ", F.concat(F.lit("%% S. "), page.cast("string")), origin, layout), F.lit(" %%"))


def build(pages: DataFrame, key: str, page: str = "page_no", text: str = "markdown", last_page: Column | None = None, per_part: int = 2_000) -> DataFrame:
    """``key, part, document``: the pages of each document in order, each under its marker. With ``last_page`` only
    those up to it, as when a run was cancelled. Longer documents come in parts of ``per_part`` page numbers."""
    p = pages if last_page is None else pages.where(F.col(page) <= last_page)
    block = F.concat(marker(F.col(page), F.col("origin"), F.col("layout")), F.lit("\n\n"), F.coalesce(F.col(text), F.lit("")))
    part = F.floor((F.col(page) - 1) / per_part).cast("int").alias("part")
    g = p.groupBy(key, part).agg(F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), block.alias("b")))).alias("bs"))
    return g.select(key, "part", F.concat(F.array_join(F.transform("bs", lambda x: x["b"]), "\n\n"), F.lit("\n")).alias("document"))

