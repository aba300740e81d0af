"""Column functions over text; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points of symbol fonts and what they show; any other private one shows a small square.
PRIVATE_GLYPHS = {"\uf0f0": "\u21e8", "\uf0e0": "\u21e8", "\uf0d8": "\u27a2", "\uf0fc": "\u2714", "\uf0b7": "\u2022", "\uf020": " "}
# Arrows in formula notation.
ARROWS = {
    "rightarrow": "→", "Rightarrow": "⇒", "leftarrow": "←", "Leftarrow": "⇐", "leftrightarrow": "↔", "Leftrightarrow": "⇔",
    "downarrow": "↓", "Downarrow": "⇩", "uparrow": "↑", "to": "→", "Longrightarrow": "⟹", "mapsto": "↦",
}
# Words before which a line-end hyphen stays.
NO_JOIN = "und|oder|bzw|sowie|als|wie|bis|von|zu|im|in"
# Statutes after which a bar was a roman one.
STATUTES = "BGB|StGB|GG|VwGO|VwVfG|ZPO|HGB"
#: A citation of a statute: sign, number, letter.
CITATION = r"(?:§{1,2}|Art\.)\s*\d+[a-z]?"
WORD = r"[\p{L}\p{N}_§€%]+"
# A place in a statute, and a citation with all its places and the name of the statute, which has two capitals.
NORM = r"\d+[a-z]?(?:\s*[IVXlivx]+)?(?:\s*(?:Abs|S|Satz|Alt|Nr|HS|Hs|Var|lit)\.?\s*\d+[a-z]?)*"
NAMED_CITATION = rf"(?:§{{1,2}}|Art\.)\s*{NORM}(?:\s*,\s*{NORM})*(?:\s+(?=[A-ZÄÖÜ\w]*[A-ZÄÖÜ][A-ZÄÖÜ\w]*[A-ZÄÖÜ])[A-ZÄÖÜ][A-Za-zÄÖÜäöü]{{1,8}})?"


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def tokens(c: Column) -> Column:
    """Non-blank runs; an empty array for blank text."""
    return F.filter(F.split(squeeze(F.coalesce(c, F.lit(""))), " "), lambda w: w != "")


def words_with_letters(c: Column) -> Column:
    return F.filter(tokens(c), lambda w: w.rlike(r"\p{L}"))


def count_like(words: Column, pattern: str) -> Column:
    return F.size(F.filter(words, lambda w: w.rlike(pattern)))


def citations(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({CITATION})"), F.lit(1))


def named_citations(c: Column) -> Column:
    """Citations with their statutes, blanks squeezed."""
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({NAMED_CITATION})"), F.lit(1)), squeeze)


def word_list(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def blind_digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\d+", "#")


def seam_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^0-9a-zäöüß]+", "")


def without_bold(c: Column) -> Column:
    return F.trim(F.replace(c, F.lit("**"), F.lit("")))


def only_bold(c: Column) -> Column:
    return c.contains("**") & (F.trim(F.regexp_replace(c, r"(?s)\*\*.*?\*\*", "")) == "")


def balance_bold(c: Column) -> Column:
    """Without its last ``**`` if their number is odd."""
    n = F.regexp_count(c, F.lit(r"\*\*"))
    at = F.char_length(c) - F.locate("**", F.reverse(c)) - 1  # characters before the last pair
    return F.when(n % 2 == 1, F.concat(F.substring(c, F.lit(1), at), F.substring(c, at + 3, F.char_length(c)))).otherwise(c)


def acronym(c: Column) -> Column:
    """All letters upper case, or one after the first is."""
    return (c.rlike(r"\p{L}") & ~c.rlike(r"\p{Ll}")) | F.substring(c, F.lit(2), F.char_length(c)).rlike(r"\p{Lu}")


def plain_text(c: Column) -> Column:
    """Markup out, content kept: page marks, pictures, call-outs, headings, footnote marks, bold, bars."""
    for pattern, by in (
        (r"(?s)%%.*?%%", " "),
        (r"!\[\[.*?\]\]", " "),
        (r"(?m)^\s*>\s?", ""),
        (r"(?m)^#{1,6}\s*", ""),
        (r"\[\^(\d+)\]:?", " $1 "),
        (r"\*\*|\|", " "),
    ):
        c = F.regexp_replace(c, pattern, by)
    return squeeze(c)


def clean_cell(c: Column) -> Column:
    """Cell of a table: parted words joined, one line, bars escaped."""
    c = F.trim(c)
    c = F.regexp_replace(c, r"([a-zäöüß])-\s*\n\s*([a-zäöüß])", "$1$2")
    c = F.regexp_replace(c, r"\s*\n\s*", " ")
    c = F.replace(c, F.lit("|"), F.lit("\\|"))
    return F.regexp_replace(c, r"\s+", " ")


def show_private(c: Column) -> Column:
    c = F.translate(c, "".join(PRIVATE_GLYPHS), "".join(PRIVATE_GLYPHS.values()))
    return F.regexp_replace(c, "[\ue000-\uf8ff]", "▪")


def clean_line(c: Column) -> Column:
    """A recognised line in plain notation: symbols, arrows, underlines, footnote marks, signs of sections.

    Most lines hold nothing of the kind and pass one cheap test only.
    """
    odd = c.rlike("[$\\\\^|\ue000-\uf8ff]|§\\s|\\*\\*\\s*\\*\\*|\\s$")
    line, c = c, show_private(c)
    for name, arrow in ARROWS.items():
        c = F.regexp_replace(c, rf"\$?\\{name}\$?(?![A-Za-z])", arrow)
    for pattern, by in (
        (r"\\\(\\underline\{\\text\{(.*?)\}\}\\\)", "$1"),
        (r"\\underline\{(.*?)\}", "$1"),
        (r"\\text\{(.*?)\}", "$1"),
        (r"\\\(|\\\)", ""),
        (r"\^\{(\d{1,2})\}", "[^$1]"),
        (r"\$\s*(?=\d)", "§ "),
        (r"§\s*§\s*", "§§ "),
        (r"§\s+(?=\d)", "§ "),
        (r"(§+\s*\d+[a-z]?\s*)\|", "$1I"),
        (rf"\|\s+(?=(?:{STATUTES})\b)", "I "),
        (r"\*\*(\s*)\*\*", "$1"),
        (r"\s+$", ""),
    ):
        c = F.regexp_replace(c, pattern, by)
    return F.when(odd, c).otherwise(line)


def join_hyphen(a: Column, b: Column) -> Column:
    """Two lines as one: a hyphen at the first one's end goes unless a conjunction or a capital follows."""
    parted = a.endswith("-") & b.rlike(r"^\p{Ll}") & ~b.rlike(rf"^(?:{NO_JOIN})\b")
    return F.when(parted, F.concat(F.substring(a, F.lit(1), F.char_length(a) - 1), b)).otherwise(F.concat_ws(" ", a, b))


def natural_key(c: Column) -> Column:
    """Sort key in which numbers count by value: each is padded to ten digits."""
    parts = F.regexp_extract_all(c, F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d+$"), F.lpad(p, 10, "0")).otherwise(F.lower(p))), "")


def human_size(n: Column) -> Column:
    return (
        F.when(n < 1024, F.format_string("%d B", n))
        .when(n < 1024**2, F.format_string("%.1f KB", n / 1024))
        .when(n < 1024**3, F.format_string("%.1f MB", n / 1024**2))
        .otherwise(F.format_string("%.1f GB", n / 1024**3))
    )


def callout(text: Column, title: Column) -> Column:
    """Text in a folded note: every line quoted."""
    body = F.array_join(F.transform(F.split(text, "\n"), lambda x: F.concat(F.lit("> "), x)), "\n")
    return F.concat(F.lit("> [!note]- "), title, F.lit("\n"), F.regexp_replace(body, r"[\n> ]+$", ""))
