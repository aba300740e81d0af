"""Files on disk against the recorded states of entries: reconciliation and look-ups around it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blattwerk.operators.history import canonical_status

#: Keys of a file's head in today's and in the old wording.
HEAD_KEYS = {
    "source_pdf": ("source-pdf", "quelle-pdf"),
    "pages": ("pages", "seiten"),
    "pages_ocr": ("pages-ocr", "seiten-ocr"),
    "pages_diagram": ("pages-diagram", "seiten-diagramm"),
    "ocr_date": ("ocr-date", "ocr-datum"),
    "ocr_timestamp": ("ocr-timestamp", "ocr-zeitpunkt"),
}


def head_text(head: Column, field: str) -> Column:
    """A text field of a file's head under either key: trimmed, without its quotes; null if blank."""

    def one(key: str) -> Column:
        v = F.trim(F.try_element_at(head, F.lit(key)))
        v = F.trim(F.when((F.char_length(v) > 1) & v.rlike(r"""^(".*"|'.*')$"""), F.substring(v, F.lit(2), F.char_length(v) - 2)).otherwise(v))
        return F.when(v != "", v)

    return F.coalesce(*[one(k) for k in HEAD_KEYS[field]])


def head_number(head: Column, field: str) -> Column:
    """The whole number that a field of a file's head begins with."""
    return F.regexp_extract(head_text(head, field), r"^\s*([+-]?\d+)", 1).try_cast("int")


def latest_states(manifest: DataFrame) -> DataFrame:
    """The state of each entry: of its last ``updated`` the row loaded last."""
    rest = [c for c in manifest.columns if c != "name"]
    last = F.max_by(F.struct(*rest), F.struct("updated", "loaded_at", "status")).alias("s")
    return manifest.where("name IS NOT NULL").groupBy("name").agg(last).select("name", "s.*")


def reconcile(files: DataFrame, states: DataFrame, elsewhere: DataFrame | None = None) -> DataFrame:
    """``name, status, action, path, decided`` of each entry after the folders were read.

    ``files`` (``name, path, location, frontmatter``) may hold a name in two folders: the open one is the newest.
    Rules, first hit: a file without entry is new; a decided entry whose file is there twice or has another
    date was made anew, and so was an open one with another date; else the folder decides, but an entry made
    anew stays so in the open folder. An entry without file is adopted if its path stands in ``elsewhere``
    (``path``), else it goes (it is not in the result).
    """
    f = (
        files.where("name IS NOT NULL")
        .groupBy("name")
        .agg(
            F.max_by(F.struct("path", "location", "frontmatter"), F.struct(F.col("location") == "open", "path")).alias("f"),
            F.max((F.col("location") == "open").cast("int")).alias("is_open"),
            F.max((F.col("location") != "open").cast("int")).alias("is_decided"),
        )
    )
    s = states.select("name", canonical_status(F.col("status")).alias("old"), F.col("path").alias("old_path"), "decided", F.coalesce("ocr_timestamp", "ocr_date").alias("old_date"), F.lit(True).alias("known"))
    j = f.join(s, "name", "full")
    now = F.coalesce(head_text(F.col("f.frontmatter"), "ocr_timestamp"), head_text(F.col("f.frontmatter"), "ocr_date"))
    twice = (F.col("is_open") == 1) & (F.col("is_decided") == 1)
    dated = F.coalesce((F.col("is_open") == 1) & (now != F.col("old_date")), F.lit(False))
    was_decided = F.coalesce(F.col("old").isin("accepted", "rejected"), F.lit(False))
    here = F.col("f.location")
    agrees = F.coalesce((F.col("old") == here) | ((F.col("old") == "re-created") & (here == "open")), F.lit(False))
    j = j.withColumn(
        "action",
        F.when(F.col("f").isNull(), "gone")
        .when(F.col("known").isNull(), "new")
        .when(was_decided & (twice | dated), "re-created")
        .when(dated, "re-created")
        .when(agrees, "kept")
        .otherwise("corrected"),
    )
    if elsewhere is not None:
        there = elsewhere.select(F.col("path").alias("old_path"), F.lit(True).alias("there")).distinct()
        j = j.join(there, "old_path", "left")
        j = j.withColumn("action", F.when((F.col("action") == "gone") & F.col("there") & (F.coalesce("old_path", F.lit("")) != ""), "adopted").otherwise(F.col("action")))
    status = (
        F.when(F.col("action").isin("new", "corrected"), here).when(F.col("action") == "re-created", "re-created").when(F.col("action") == "adopted", "adopted").otherwise(F.col("old"))
    )
    # a new entry is undecided; so is one made anew after a decision, and one moved to the open folder
    clears = (F.col("action") == "new") | ((F.col("action") == "re-created") & was_decided) | ((F.col("action") == "corrected") & (here == "open"))
    return j.where("action <> 'gone'").select("name", status.alias("status"), "action", F.coalesce(F.col("f.path"), F.col("old_path")).alias("path"), F.when(~clears, F.col("decided")).alias("decided"))


def parent(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[A-Za-z0-9]{1,4}$", "")


def conflicts(files: DataFrame) -> DataFrame:
    """``name, paths`` of names that stand under more than one path."""
    return files.groupBy("name").agg(F.countDistinct("path").alias("paths")).where("paths > 1")


def originals(previews: DataFrame, files: DataFrame, manual: DataFrame) -> DataFrame:
    """``name, original, by``: the first of the head's path, the source column, the file of the same stem, the manual path."""
    f = files.select(stem(F.col("path")).alias("name"), "path").groupBy("name").agg(F.min("path").alias("by_stem"))
    m = manual.groupBy("name").agg(F.max("manual_source_pdf").alias("manual"))
    j = previews.select("name", head_text(F.col("frontmatter"), "source_pdf").alias("head"), F.col("source_pdf").alias("link")).join(f, "name", "left").join(m, "name", "left")
    by = F.when(F.col("head").isNotNull(), "head").when(F.col("link").isNotNull(), "link").when(F.col("by_stem").isNotNull(), "stem").when(F.col("manual").isNotNull(), "manual")
    return j.select("name", F.coalesce("head", "link", "by_stem", "manual").alias("original"), by.alias("by"))


def parts(names: DataFrame, col: str = "name") -> DataFrame:
    """``base, name, part``: the files that are parts of one, and the place of each in the order of their numbers."""
    base = F.regexp_replace(F.col(col), r" Teil \d+$", "")
    no = F.coalesce(F.regexp_extract(F.col(col), r" Teil (\d+)$", 1).try_cast("int"), F.lit(0))
    p = names.select(base.alias("base"), F.col(col).alias("name"), no.alias("no")).distinct()
    return p.select("base", "name", F.row_number().over(Window.partitionBy("base").orderBy("no", "name")).alias("part"))


def free_names(wanted: DataFrame, taken: DataFrame, name: str, date: str) -> DataFrame:
    """``wanted`` with ``target``: name and date, with the first running number (from 2) that neither a taken name has nor
    one of those that ask before it. Equal rows are requests of their own."""
    t = F.concat_ws("-", F.col(name), F.coalesce(F.col(date), F.lit("old")))
    w = wanted.withColumn("_t", t).withColumn("_r", F.row_number().over(Window.partitionBy("_t").orderBy(name, *[c for c in wanted.columns if c != name])))
    # a taken name is the first of its own kind, and maybe the k-th of a shorter one
    k = F.regexp_extract("target", r"-([1-9]\d{0,8})$", 1).try_cast("int")
    known = taken.select("target").where("target IS NOT NULL").distinct()
    firsts = known.unionByName(w.select(F.col("_t").alias("target")).distinct())  # what others ask for is taken, too
    slots = known.select(F.col("target").alias("_t"), F.lit(1).alias("_k")).unionByName(firsts.where(k >= 2).select(F.regexp_replace("target", r"-\d+$", "").alias("_t"), k.alias("_k"))).distinct()
    asked = w.groupBy("_t").agg(F.max("_r").alias("_m"))
    held = asked.join(slots, "_t").groupBy("_t", "_m").agg(F.count(F.lit(1)).alias("_n"))
    places = asked.join(held, ["_t", "_m"], "left").select("_t", F.explode(F.expr("sequence(1, _m + CAST(coalesce(_n, 0) AS INT))")).alias("_k")).join(slots, ["_t", "_k"], "left_anti")
    free = places.withColumn("_r", F.row_number().over(Window.partitionBy("_t").orderBy("_k")))
    made = F.when(F.col("_k") > 1, F.concat(F.col("_t"), F.lit("-"), F.col("_k").cast("string"))).otherwise(F.col("_t"))
    return w.join(free, ["_t", "_r"]).select(*wanted.columns, made.alias("target"))


def folder_of(status: Column, open_folder: str, accepted: str, rejected: str) -> Column:
    """The folder in which a file of a status stands; null for one that stands elsewhere."""
    return F.when(status == "accepted", accepted).when(status == "rejected", rejected).when(status.isin("open", "re-created"), open_folder)


def marker_fields(marker: Column) -> dict[str, Column]:
    """Page number, origin and layout of a page marker line; an unknown origin is part of the layout."""
    p = r"(?i)^%%\s*(?:S\.|p\.|P\.)\s*(\d+)\s*(?:\|(.*?))?\s*%%\s*$"
    parts_ = F.filter(F.transform(F.split(F.regexp_extract(marker, p, 2), r"\|"), lambda x: F.trim(x)), lambda x: x != "")
    first = F.get(parts_, F.lit(0))
    origin = F.when(first.isin("textlayer", "ocr"), first).when(first.isin("diagram", "diagramm"), "diagram")
    rest = F.when(origin.isNull(), parts_).otherwise(F.slice(parts_, F.lit(2), F.greatest(F.size(parts_), F.lit(0))))
    layout = F.array_join(rest, " | ")
    return {"page": F.regexp_extract(marker, p, 1).try_cast("int"), "origin": origin, "layout": F.when(layout != "", layout)}
