"""Outline levels, headings and labels of lines and paragraphs, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blattwerk.functions import text as T

# Marks that open an outline level, in the order they are tried.
LEVELS = (
    (r"^\((?:\d{1,2}|[a-h]{1,2})\)(?=\s)", 6),
    (r"^(?:(?:aa|bb|cc|dd|ee|gg|hh)[.)]|ff\))(?=\s)", 6),
    (r"^(?:[a-eg-h][.)]|f\))(?=\s)", 5),
    (r"^\d{1,2}[.)](?=\s)", 4),
    (r"^[IVX]{1,5}\.(?=\s)", 3),
    (r"^[A-H][.)](?=\s)", 2),
)
# Marks of list items, and words that label a remark.
ENUMERATION = r"^\s*(?:[-•·▪○●⇒⇨→➢✔]|\(?\d{1,2}[.)]|[a-z]{1,3}[.)]|[IVXL]{1,5}\.)(?:\s|$)"
LABELS = "Anmerkung|Hinweis|Merksatz|Merke|Ergebnis|Beachte|Achtung|Exkurs|Vertiefung|Klausurtipp|Zwischenergebnis|Beispiele|Beispiel|Definition"
LONGEST_HEADING = 90
# One cheap test each that every line with an outline mark or list mark passes, bold or not; most lines stop there.
_MAY_LEVEL = r"^[\s*(]*[0-9A-Za-z*]{1,8}[.)]"
_MAY_ITEM = r"^[\s*]*(?:[-•·▪○●⇒⇨→➢✔]|\(?[\s*]*[0-9a-zIVXL*]{1,8}[.)])"


def _bare(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"\*+", ""), r"^\s+", "")


def enumeration(c: Column) -> Column:
    return c.rlike(_MAY_ITEM) & _bare(c).rlike(ENUMERATION)


def keyword(c: Column) -> Column:
    return c.contains(":") & _bare(c).rlike(rf"(?i)^(?:{LABELS})\s*:")


def margin_label(c: Column) -> Column:
    return F.trim(c).rlike(rf"(?i)^\**\s*(?:{LABELS})\s*:?\s*\**$")


def level(c: Column) -> Column:
    """Outline level from 2 to 6; none if an abbreviation follows the mark."""
    bare = _bare(c)
    out = F.lit(None).cast("int")
    for pattern, n in reversed(LEVELS):
        rest = F.regexp_replace(F.regexp_replace(bare, pattern, ""), r"^\s+", "")
        out = F.when(bare.rlike(pattern), F.when(~rest.rlike(r"^[A-Za-zÄÖÜ]{1,2}\."), F.lit(n))).otherwise(out)
    return F.when(c.rlike(_MAY_LEVEL), out)


def heading(c: Column) -> Column:
    """A short line that is one bold run and no label."""
    one = c.startswith("**") & c.endswith("**") & (F.regexp_count(c, F.lit(r"\*\*")) == 2)
    return one & (F.char_length(F.regexp_replace(c, r"^\*+\s*", "")) <= LONGEST_HEADING) & ~margin_label(c)


def line_start(c: Column) -> Column:
    """A line at which a thought begins: a list item or a bold heading."""
    one = c.startswith("**") & c.endswith("**") & (F.regexp_count(c, F.lit(r"\*\*")) == 2)
    return enumeration(c) | (one & (F.char_length(F.regexp_replace(c, r"^\*+\s*", "")) <= LONGEST_HEADING))


def format_heading(c: Column) -> Column:
    """A paragraph with its outline level made visible."""
    raw = F.regexp_replace(c, r"^\s+", "")
    lvl, blank = level(raw), T.without_bold(raw)
    short = (F.char_length(blank) <= LONGEST_HEADING) | T.only_bold(raw)
    no_stop = ~blank.rlike("[.!?][\"“»)\\]]?$") | raw.contains("**")
    mark, rest = F.regexp_extract(raw, r"^(\S+)\s*", 1), F.regexp_replace(raw, r"^\S+\s*", "")
    return (
        F.when(lvl.isNull() | raw.rlike(r"^[|>\[]"), c)
        .when(short & no_stop, F.concat(F.repeat(F.lit("#"), lvl), F.lit(" "), blank))
        .when(~raw.startswith("**") & ~mark.rlike(r"^\d"), F.concat(F.lit("**"), mark, F.lit("** "), rest))
        .otherwise(c)
    )
