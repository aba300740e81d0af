"""The recorded states as JSON: read tolerantly, under today's and old keys; written in the order of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Field, today's key, old key, type.
FIELDS = (
    ("status", "status", "zustand", "string"), ("path", "path", "pfad", "string"), ("source_pdf", "source-pdf", "quelle-pdf", "string"), ("pages", "pages", "seiten", "int"),
    ("pages_ocr", "pages-ocr", "seiten-ocr", "int"), ("pages_diagram", "pages-diagram", "seiten-diagramm", "int"), ("ocr_date", "ocr-date", "ocr-datum", "string"),
    ("ocr_timestamp", "ocr-timestamp", "ocr-zeitpunkt", "string"), ("decided", "decided", "entschieden", "string"), ("checked_until", "checked-until", "geprueft-bis", "int"), ("note", "note", "notiz", "string"),
)
# What a status is called; anything else is open.
STATUS = {"offen": "open", "akzeptiert": "accepted", "abgelehnt": "rejected", "neu-erzeugt": "re-created", "uebernommen": "adopted"}


def status(c: Column) -> Column:
    names = STATUS | {v: v for v in STATUS.values()}
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(known, c), F.lit("open"))


def entries(json: Column) -> Column:
    """The entries of a manifest as a map from name to JSON text; null if it is none."""
    return F.from_json(F.coalesce(F.get_json_object(json, "$.entries"), F.get_json_object(json, "$.eintraege")), "map<string,string>")


def read_entries(files: DataFrame, text: str) -> DataFrame:
    """``name`` and ``FIELDS`` of each entry; a value of the wrong kind is null, an unknown status open, a blank text null."""
    e = files.select(F.explode(entries(F.col(text))).alias("name", "json"))

    def field(key: str, old: str, kind: str) -> Column:
        raw = F.coalesce(F.get_json_object("json", f"$['{key}']"), F.get_json_object("json", f"$['{old}']"))
        return raw.try_cast("int") if kind == "int" else F.when(raw != "", raw)

    cols = [field(key, old, kind).alias(name) for name, key, old, kind in FIELDS]
    return e.select("name", *cols).withColumn("status", status(F.coalesce("status", F.lit(""))))


def write_entries(states: DataFrame) -> DataFrame:
    """``name, entry``: each entry as JSON under today's keys, in the order of names."""
    return states.select("name", F.to_json(F.struct(*[F.col(name).alias(key) for name, key, _, _ in FIELDS if name in states.columns])).alias("entry")).orderBy("name")


def manifest_of(states: DataFrame, updated: str, per_file: int = 5_000) -> DataFrame:
    """``file, json``: the manifest in files of about ``per_file`` entries, by hash of the name."""
    files = max(1, -(-states.count() // per_file))
    e = write_entries(states).groupBy(F.pmod(F.xxhash64("name"), F.lit(files)).alias("file")).agg(F.array_sort(F.collect_list(F.concat(F.to_json(F.struct(F.col("name").alias("n"))), F.lit("\x00"), F.col("entry")))).alias("es"))
    pair = lambda x: F.concat(F.regexp_extract(x, '^\\{"n":(".*")\\}\x00', 1), F.lit(":"), F.regexp_replace(x, "^[^\x00]*\x00", ""))
    return e.select("file", F.concat(F.lit('{"version":1,"updated":"' + updated + '","entries":{'), F.array_join(F.transform("es", pair), ","), F.lit("}}")).alias("json"))
