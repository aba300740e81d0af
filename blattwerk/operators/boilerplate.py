"""Lines of page furniture by fixed rules: hard patterns, weak signals in zones, lists of places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Places that head and foot lines list.
PLACES = (
    "Augsburg Bayreuth Berlin Potsdam Bielefeld Bochum Bonn Bremen Düsseldorf Erlangen Frankfurt Freiburg Göttingen Greifswald Halle Hamburg Hannover "
    "Heidelberg Jena Kiel Köln Konstanz Leipzig Lüneburg Mainz Mannheim Marburg Gießen München Münster Nürnberg Osnabrück Passau Regensburg Saarbrücken "
    "Trier Tübingen Stuttgart Wiesbaden Würzburg Rostock Dresden"
).split()
# Lines that are furniture wherever they stand.
HARD = (
    r"^Juristisches\s+Repetitorium",
    r"(?i)^hemmer\s*$",
    r"^Hauptkurs\s*/",
    r"^h\s*/\s*w\s*/\s*t\b",
    r"^\\lambda\s*/\s*\\omega",
    r"^[–\-—]\s*\d+\s*[–\-—]?\s*$",
    r"^\d{1,3}\s*[-–]\s*[Il1]\s*$",
)
# Signals that count in short lines and in the zones.
WEAK = (
    r"(?i)^he[mn]+er\s*[.,:]?$",
    r"(?i)^[^\p{L}\p{N}_]*(?:Juristisches\s*)?Repetitorium[^\p{L}\p{N}_]*$",
    r"^(?:BGB|StGB|StR|ZR|OeR|ÖR)[\s-]*(?:AT|BT)?\s*$",
    r"(?i)(?:Lösung|Sachverhalte?|Übersicht)\s*[-–]\s*Seite",
    r"^Fall\s*\d*\s*[-–]?\s*L[äöa]?",
    r"(?i)^\s*Seite\s*\d+\s*$",
)
HEAD, FOOT, NUMBER_HEAD, NUMBER_FOOT, SHORT, SHORT_PLACE = 70, 950, 80, 905, 45, 40


def boilerplate(text: Column, y: Column) -> Column:
    """Whether a line at height ``y`` (0 to 1000, or null) is furniture. Lines known to run are joined apart."""
    t = F.trim(F.regexp_replace(F.trim(text), r"^\*+|\*+$", ""))
    # lists of places are joined by hyphens, so other lines are not searched for them
    places = F.when(t.contains("-"), F.size(F.filter(F.array(*[F.lit(p) for p in PLACES]), lambda p: t.contains(p)))).otherwise(0)

    def any_of(patterns: tuple[str, ...]) -> Column:
        return t.rlike("|".join(f"(?:{p})" for p in patterns))

    weak = any_of(WEAK)
    height = F.coalesce(y.cast("int"), F.lit(500))
    in_zone = (height <= HEAD) | (height >= FOOT)
    fragment = t.rlike(rf"^(?:{'|'.join(PLACES)})\s*[-–]\s*(?:[A-ZÄÖÜ][A-Za-zäöüß]{{0,12}}\.?)?$")
    return (t != "") & (
        any_of(HARD)
        | ((F.regexp_count(t, F.lit(" - ")) >= 2) & (places >= 2))
        | fragment
        | ((F.char_length(t) <= SHORT) & weak)
        | (((height <= NUMBER_HEAD) | (height >= NUMBER_FOOT)) & t.rlike(r"^\d{1,4}$"))
        | (in_zone & (weak | ((F.char_length(t) <= SHORT_PLACE) & (places >= 1) & t.contains("-"))))
    )
