"""Queries on previews, their files and recorded states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blattwerk.operators import review as R
from blattwerk.queries.quality import BLOCKS
from blattwerk.queries.registry import register
from blattwerk.sources.pages import blocks
from blattwerk.sources.tables import table


def _head(field: str, col: str = "frontmatter") -> str:
    def one(key: str) -> str:
        v = f"trim({col}['{key}'])"
        return f"nullif(trim(CASE WHEN length({v}) > 1 AND regexp_matches({v}, '^(\".*\"|''.*'')$') THEN substr({v}, 2, length({v}) - 2) ELSE {v} END), '')"

    return f"coalesce({', '.join(one(k) for k in R.HEAD_KEYS[field])})"


_STATUS = "CASE {c} WHEN 'offen' THEN 'open' WHEN 'akzeptiert' THEN 'accepted' WHEN 'abgelehnt' THEN 'rejected' WHEN 'neu-erzeugt' THEN 're-created' WHEN 'uebernommen' THEN 'adopted' ELSE nullif(trim({c}), '') END"
_STATES = "states AS (SELECT * FROM manifest WHERE name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY updated DESC NULLS LAST, loaded_at DESC NULLS LAST, status DESC NULLS LAST) = 1)"

register(
    "head_fields",
    lambda s, d: table(s, d, "preview").select("name", *[R.head_text(F.col("frontmatter"), f).alias(f) for f in ("source_pdf", "ocr_date", "ocr_timestamp")], R.head_number(F.col("frontmatter"), "pages").alias("pages")),
    f"SELECT name, {_head('source_pdf')} AS source_pdf, {_head('ocr_date')} AS ocr_date, {_head('ocr_timestamp')} AS ocr_timestamp, TRY_CAST(regexp_extract({_head('pages')}, '^[ ]*([+-]?[0-9]+)', 1) AS INT) AS pages FROM preview",
)
register(
    "latest_states",
    lambda s, d: R.latest_states(table(s, d, "manifest")).select("name", "status", "updated"),
    f"WITH {_STATES} SELECT name, status, updated FROM states",
)
register(
    "reconcile",
    lambda s, d: R.reconcile(table(s, d, "found_file"), R.latest_states(table(s, d, "manifest")), table(s, d, "manifest").where("status = 'adopted'").select("path")),
    f"""WITH {_STATES}, f AS (SELECT name, max(CASE WHEN location = 'open' THEN 1 ELSE 0 END) AS is_open, max(CASE WHEN location <> 'open' THEN 1 ELSE 0 END) AS is_decided,
  arg_max(struct_pack(path := path, location := location, fm := frontmatter), (location = 'open', path)) AS f FROM found_file WHERE name IS NOT NULL GROUP BY name),
s AS (SELECT name, {_STATUS.format(c="status")} AS old, path AS old_path, decided, coalesce(ocr_timestamp, ocr_date) AS old_date FROM states),
j AS (SELECT coalesce(f.name, s.name) AS name, f.name AS fname, s.name AS sname, f.f.path AS path, f.f.location AS here, coalesce({_head("ocr_timestamp", "f.f.fm")}, {_head("ocr_date", "f.f.fm")}) AS today, is_open, is_decided, old, old_path, decided, old_date FROM f FULL JOIN s ON f.name = s.name),
k AS (SELECT *, is_open = 1 AND is_decided = 1 AS twice, coalesce(is_open = 1 AND today <> old_date, false) AS dated, coalesce(old IN ('accepted', 'rejected'), false) AS was FROM j),
a AS (SELECT *, CASE WHEN fname IS NULL THEN CASE WHEN coalesce(old_path, '') <> '' AND old_path IN (SELECT path FROM manifest WHERE status = 'adopted' AND path IS NOT NULL) THEN 'adopted' ELSE 'gone' END
  WHEN sname IS NULL THEN 'new' WHEN was AND (twice OR dated) THEN 're-created' WHEN dated THEN 're-created' WHEN coalesce(old = here OR (old = 're-created' AND here = 'open'), false) THEN 'kept' ELSE 'corrected' END AS action FROM k)
SELECT name, CASE WHEN action IN ('new', 'corrected') THEN here WHEN action = 're-created' THEN 're-created' WHEN action = 'adopted' THEN 'adopted' ELSE old END AS status, action, coalesce(path, old_path) AS path,
  CASE WHEN NOT coalesce(action = 'new' OR (action = 're-created' AND was) OR (action = 'corrected' AND here = 'open'), false) THEN decided END AS decided FROM a WHERE action <> 'gone'""",
)
register(
    "entries_without_file",
    lambda s, d: R.latest_states(table(s, d, "manifest")).join(table(s, d, "found_file").select("name").distinct(), "name", "left_anti").select("name", "path"),
    f"WITH {_STATES} SELECT name, path FROM states WHERE name NOT IN (SELECT name FROM found_file WHERE name IS NOT NULL)",
)
register(
    "folder_files",
    lambda s, d: table(s, d, "found_file").groupBy(R.parent(F.col("path")).alias("folder"), "location").agg(F.count(F.lit(1)).alias("files")),
    "SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, location, count(*) AS files FROM found_file GROUP BY ALL",
)
register("dup_stem", lambda s, d: R.conflicts(table(s, d, "found_file")), "SELECT name, count(DISTINCT path) AS paths FROM found_file GROUP BY name HAVING count(DISTINCT path) > 1")
register(
    "original_lookup",
    lambda s, d: R.originals(table(s, d, "preview"), table(s, d, "found_file"), table(s, d, "manifest")),
    f"""WITH f AS (SELECT regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\\.[A-Za-z0-9]{{1,4}}$', '') AS name, min(path) AS by_stem FROM found_file GROUP BY ALL),
m AS (SELECT name, max(manual_source_pdf) AS manual FROM manifest GROUP BY name), j AS (SELECT preview.name, {_head("source_pdf")} AS head, source_pdf AS link, by_stem, manual FROM preview LEFT JOIN f USING (name) LEFT JOIN m USING (name))
SELECT name, coalesce(head, link, by_stem, manual) AS original, CASE WHEN head IS NOT NULL THEN 'head' WHEN link IS NOT NULL THEN 'link' WHEN by_stem IS NOT NULL THEN 'stem' WHEN manual IS NOT NULL THEN 'manual' END AS by FROM j""",
)
register(
    "part_groups",
    lambda s, d: R.parts(table(s, d, "preview")),
    """WITH p AS (SELECT DISTINCT regexp_replace(name, ' Teil [0-9]+$', '') AS base, coalesce(TRY_CAST(regexp_extract(name, ' Teil ([0-9]+)$', 1) AS INT), 0) AS no, name FROM preview)
SELECT base, name, CAST(row_number() OVER (PARTITION BY base ORDER BY no, name) AS INT) AS part FROM p""",
)
_STEM = "regexp_replace(name, ' [0-9]+.*$', '')"
register(
    "free_names",
    # every file asks for the name of its series; the names of all entries are taken
    lambda s, d: R.free_names(table(s, d, "found_file").where("name IS NOT NULL").select(F.regexp_replace("name", r" \d+.*$", "").alias("stem"), "path", F.lit("2").alias("date")), _taken(s, d), "stem", "date").groupBy("target").count(),
    f"""WITH w AS (SELECT {_STEM} || '-2' AS t, row_number() OVER (PARTITION BY {_STEM} ORDER BY path) AS r FROM found_file WHERE name IS NOT NULL),
k AS (SELECT DISTINCT {_STEM} || CASE WHEN length(name) % 2 = 0 THEN '-2' ELSE '-2-' || length(name) END AS target FROM manifest WHERE name IS NOT NULL),
s AS (SELECT target AS t, 1 AS k FROM k UNION SELECT regexp_replace(target, '-[0-9]+$', ''), CAST(regexp_extract(target, '-([1-9][0-9]{{0,8}})$', 1) AS INT) FROM (SELECT target FROM k UNION SELECT t FROM w) WHERE regexp_matches(target, '-[1-9][0-9]{{0,8}}$') AND CAST(regexp_extract(target, '-([1-9][0-9]{{0,8}})$', 1) AS INT) >= 2),
p AS (SELECT t, unnest(range(1, max(r) + (SELECT count(*) FROM s) + 1)) AS k FROM w GROUP BY t),
f AS (SELECT t, k, row_number() OVER (PARTITION BY t ORDER BY k) AS r FROM p WHERE (t, k) NOT IN (SELECT t, k FROM s))
SELECT CASE WHEN k > 1 THEN t || '-' || k ELSE t END AS target, count(*) AS count FROM w JOIN f USING (t, r) GROUP BY ALL""",
)


def _taken(s: SparkSession, d: str) -> DataFrame:
    stem, n = F.regexp_replace("name", r" \d+.*$", ""), F.char_length("name")
    return table(s, d, "manifest").where("name IS NOT NULL").select(F.concat(stem, F.when(n % 2 == 0, F.lit("-2")).otherwise(F.concat(F.lit("-2-"), n.cast("string")))).alias("target")).distinct()


register(
    "marker_fields",
    lambda s, d: blocks(s, d).select("block_id", *[c.alias(k) for k, c in R.marker_fields(F.coalesce("marker_line", F.lit(""))).items()]),
    f"""WITH {BLOCKS}, p AS (SELECT block_id, TRY_CAST(regexp_extract(coalesce(marker_line, ''), '(?i)^%%[ ]*(?:S\\.|p\\.)[ ]*([0-9]+)', 1) AS INT) AS page,
  list_filter(list_transform(string_split(regexp_extract(coalesce(marker_line, ''), '(?i)^%%[ ]*(?:S\\.|p\\.)[ ]*[0-9]+[ ]*\\|(.*?)[ ]*%%[ ]*$', 1), '|'), lambda x: trim(x)), lambda x: x <> '') AS parts FROM blocks),
o AS (SELECT *, CASE WHEN parts[1] IN ('textlayer', 'ocr') THEN parts[1] WHEN parts[1] IN ('diagram', 'diagramm') THEN 'diagram' END AS origin FROM p)
SELECT block_id, page, origin, nullif(array_to_string(CASE WHEN origin IS NULL THEN parts ELSE parts[2:] END, ' | '), '') AS layout FROM o""",
)
register(
    "status_list",
    lambda s, d: R.latest_states(table(s, d, "manifest")).where(F.col("status").isin("open", "re-created") & F.lower("name").contains("recht")).orderBy("name").limit(50).select("name", "status"),
    f"WITH {_STATES} SELECT name, status FROM states WHERE status IN ('open', 're-created') AND contains(lower(name), 'recht') ORDER BY name LIMIT 50",
)
register(
    "origin_disagreements",
    lambda s, d: blocks(s, d).select("block_id", "origin", R.marker_fields(F.coalesce("marker_line", F.lit("")))["origin"].alias("marked")).where("origin IS NOT NULL AND marked IS NOT NULL AND replace(origin, 'diagramm', 'diagram') <> marked"),
    f"""WITH {BLOCKS}, p AS (SELECT block_id, origin, trim(regexp_extract(coalesce(marker_line, ''), '\\|([^|%]*)', 1)) AS m FROM blocks), o AS (SELECT block_id, origin, CASE WHEN m IN ('textlayer', 'ocr') THEN m WHEN m IN ('diagram', 'diagramm') THEN 'diagram' END AS marked FROM p)
SELECT * FROM o WHERE origin IS NOT NULL AND marked IS NOT NULL AND replace(origin, 'diagramm', 'diagram') <> marked""",
)
