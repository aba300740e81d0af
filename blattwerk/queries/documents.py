"""Queries that build documents, take them apart, assemble paragraphs, and replay streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blattwerk.functions import text as T
from blattwerk.operators import documents as D
from blattwerk.operators import paragraphs as P
from blattwerk.queries.quality import BLOCKS, LINES
from blattwerk.queries.registry import register
from blattwerk.sources import parse
from blattwerk.sources.pages import blocks, boxed, lines_of
from blattwerk.sources.tables import table
from blattwerk.streaming import progress

_MARK = "concat_ws(' | ', '%% S. ' || page_no, origin, layout) || ' %%'"


def _documents(s: SparkSession, d: str) -> DataFrame:
    return D.build(blocks(s, d).where("name IS NOT NULL"), "name")


register(
    "build_document",
    lambda s, d: _documents(s, d).select("name", "part", F.md5("document").alias("document_md5"), F.char_length("document").alias("chars")),
    f"""WITH {BLOCKS}, g AS (SELECT name, CAST((page_no - 1) // 2000 AS INT) AS part, string_agg({_MARK} || chr(10) || chr(10) || coalesce(markdown, ''), chr(10) || chr(10) ORDER BY page_no, {_MARK} || chr(10) || chr(10) || coalesce(markdown, '')) || chr(10) AS document FROM blocks WHERE name IS NOT NULL GROUP BY ALL)
SELECT name, part, md5(document) AS document_md5, length(document) AS chars FROM g""",
)
register(
    "partial_document",
    lambda s, d: D.build(blocks(s, d).where("name IS NOT NULL"), "name", last_page=F.lit(3)).select("name", F.char_length("document").alias("chars")),
    f"""WITH {BLOCKS} SELECT name, length(string_agg({_MARK} || chr(10) || chr(10) || coalesce(markdown, ''), chr(10) || chr(10))) + 1 AS chars FROM blocks WHERE name IS NOT NULL AND page_no <= 3 GROUP BY name""",
)
register(
    "document_heads",
    lambda s, d: table(s, d, "preview").select("name", F.col("name").alias("title"), "source_pdf", "pages").select("name", D.head(["title", "source_pdf", "pages"]).alias("head")),
    """SELECT name, '---' || chr(10) || 'titel: ' || coalesce(name, 'null') || chr(10) || 'quelle-pdf: ' || coalesce('"' || replace(replace(source_pdf, '\\', '\\\\'), '"', '\\"') || '"', 'null') || chr(10) || 'seiten: ' || coalesce(CAST(pages AS VARCHAR), 'null')
  || chr(10) || 'vorschau-format: 1' || chr(10) || '---' || chr(10) AS head FROM preview""",
)
_BUILT = f"""{BLOCKS}, built AS (SELECT name, CAST((page_no - 1) // 2000 AS INT) AS part, string_agg({_MARK} || chr(10) || chr(10) || coalesce(markdown, ''), chr(10) || chr(10) ORDER BY page_no, {_MARK} || chr(10) || chr(10) || coalesce(markdown, '')) || chr(10) AS document FROM blocks WHERE name IS NOT NULL GROUP BY ALL)"""
register(
    "preview_blocks",
    lambda s, d: parse.preview_blocks(_documents(s, d), "name", "document").select("name", "block", "page", "origin", "layout", F.md5("markdown").alias("markdown_md5")),
    # what was put together comes apart again: the blocks themselves in their order
    f"""WITH {BLOCKS}, o AS (SELECT *, CASE WHEN origin IN ('textlayer', 'ocr') THEN origin WHEN origin IN ('diagram', 'diagramm') THEN 'diagram' END AS known FROM blocks WHERE name IS NOT NULL)
SELECT name, CAST(row_number() OVER (PARTITION BY name, (page_no - 1) // 2000 ORDER BY page_no, {_MARK} || chr(10) || chr(10) || coalesce(markdown, '')) AS INT) AS block, page_no AS page, known AS origin,
  nullif(concat_ws(' | ', CASE WHEN known IS NULL THEN trim(origin) END, trim(layout)), '') AS layout, md5(regexp_replace(coalesce(markdown, ''), '^[\\t\\n\\f\\r\\v ]+|[\\t\\n\\f\\r\\v ]+$', '', 'g')) AS markdown_md5 FROM o""",
)
register(
    "plain_pages",
    lambda s, d: parse.plain_pages(_documents(s, d), "name", "document").select("name", "page", F.char_length("markdown").alias("chars")),
    f"""WITH {_BUILT}, p AS (SELECT name, regexp_extract_all(document, '%% S\\. ([0-9]+)(?: \\|[^\n]*)?%%\\n*', 1) AS ns, string_split_regex(document, '%% S\\. [0-9]+(?: \\|[^\n]*)?%%\\n*') AS bs FROM built),
q AS (SELECT name, unnest(ns) AS n, unnest(bs[2:]) AS b FROM p) SELECT name, CAST(n AS INT) AS page, CAST(length(b) AS INT) AS chars FROM q""",
)
register("paragraphs", lambda s, d: P.assemble(boxed(lines_of(blocks(s, d))).withColumn("marker", F.lit(None).cast("string")), "block_id"))
register("footnote_links", lambda s, d: P.footnotes(lines_of(blocks(s, d)), "block_id", "text", "seq"))
register("trim_loops", lambda s, d: P.trim_loops(lines_of(blocks(s, d))).select("block_id", "seq", "text"))
_SEAMS = f"""{BLOCKS}, k AS (SELECT block_id, name, page_no, markdown, list_filter(list_transform(string_split_regex(coalesce(markdown, ''), '[\\t\\n\\f\\r\\v ]+'), lambda w: regexp_replace(lower(w), '[^0-9a-zäöüß]+', '', 'g')), lambda w: w <> '') AS ws FROM blocks),
h AS (SELECT *, ws[1:150] AS head, lag(ws[greatest(len(ws) - 149, 1):]) OVER (PARTITION BY name ORDER BY page_no) AS tail FROM k),
seams AS (SELECT *, coalesce(list_max(list_filter(range(0, least(len(tail), len(head)) + 1), lambda n: n >= 6 AND tail[len(tail) - n + 1:] = head[1:n] AND length(array_to_string(head[1:n], '')) >= 30)), 0) AS cut FROM h)"""
register(
    "seam_overlaps",
    lambda s, d: P.seam_overlaps(blocks(s, d), "name", "page_no", "markdown"),
    f"WITH {_SEAMS} SELECT name, page_no, CAST(cut AS INT) AS cut FROM seams WHERE tail IS NOT NULL",
)
register(
    "trim_seams",
    lambda s, d: P.trim_seams(blocks(s, d), "name", "page_no", "markdown").select("block_id", F.md5("markdown").alias("text_md5")),
    f"""WITH {_SEAMS}, p AS (SELECT *, regexp_extract_all(markdown, '[^\\t\\n\\f\\r\\v ]+[\\t\\n\\f\\r\\v ]*') AS pieces FROM seams),
c AS (SELECT *, list_filter(range(1, len(pieces) + 1), lambda i: regexp_replace(lower(pieces[i]), '[^0-9a-zäöüß]+', '', 'g') <> '') AS places FROM p)
SELECT block_id, md5(CASE WHEN cut > 0 AND tail IS NOT NULL AND name IS NOT NULL AND page_no IS NOT NULL THEN array_to_string(pieces[places[cut] + 1:], '') ELSE markdown END) AS text_md5 FROM c""",
)
register(
    "parted_words",
    lambda s, d: _joined(s, d),
    f"""WITH {LINES}, n AS (SELECT block_id, seq, text AS a, lead(text) OVER (PARTITION BY block_id ORDER BY seq) AS b FROM lines)
SELECT block_id, CAST(seq AS INT) AS seq, CASE WHEN a LIKE '%-' AND regexp_matches(b, '^\\p{{Ll}}') AND NOT regexp_matches(b, '^(?:und|oder|bzw|sowie|als|wie|bis|von|zu|im|in)\\b') THEN substr(a, 1, length(a) - 1) || b ELSE concat_ws(' ', a, b) END AS joined FROM n WHERE b IS NOT NULL""",
)


def _joined(s: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    n = lines_of(blocks(s, d)).withColumn("b", F.lead("text").over(Window.partitionBy("block_id").orderBy("seq"))).where("b IS NOT NULL")
    return n.select("block_id", "seq", T.join_hyphen(F.col("text"), F.col("b")).alias("joined"))


def _events(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events")
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


register(
    "progress_events",
    lambda s, d: progress.progress_totals(
        progress.progress_events(
            _events(s, d).select(F.to_json(F.struct(F.when(F.col("event_type") == "view", "seite").otherwise(F.col("event_type")).alias("typ"), (F.col("event_id") % 50).cast("int").alias("nr"), F.lit(50).alias("von"), F.round("value", 3).alias("sekunden"))).alias("value"))
        )
    ).select("pages", "derailed", F.round("seconds", 3).alias("seconds"), "of"),
    "SELECT count(*) AS pages, CAST(0 AS BIGINT) AS derailed, round(sum(round(value, 3)), 3) AS seconds, CASE WHEN count(*) > 0 THEN 50 END AS of FROM events WHERE event_type = 'view'",
)
register(
    "debounce_sessions",
    lambda s, d: progress.debounced(_events(s, d), "ts", "user_id", "10 minutes").groupBy("user_id").agg(F.count(F.lit(1)).alias("bursts"), F.max("events").alias("largest")),
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
r AS (SELECT user_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS burst FROM g), c AS (SELECT user_id, burst, count(*) AS n FROM r GROUP BY ALL)
SELECT user_id, count(*) AS bursts, max(n) AS largest FROM c GROUP BY user_id""",
)
register(
    "latest_wins",
    lambda s, d: progress.latest_wins(_events(s, d), "user_id", "ts", "event_id"),
    "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
register(
    "last_lines",
    lambda s, d: progress.last_lines(_events(s, d).withColumn("at", F.struct("ts", "event_id")), "user_id", "at").select("user_id", "event_id"),
    "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 5",
)
register(
    "tumbling_counts",
    lambda s, d: progress.windowed(_events(s, d), "ts", "1 hour", by=("event_type",)).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "events"),
    "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS events FROM events GROUP BY ALL",
)
register(
    "sliding_counts",
    lambda s, d: progress.windowed(_events(s, d), "ts", "2 hours", "1 hour").select(F.col("start").cast("timestamp_ntz").alias("start"), "events"),
    "WITH h AS (SELECT date_trunc('hour', ts) AS h FROM events), w AS (SELECT h AS start FROM h UNION ALL SELECT h - INTERVAL 1 HOUR FROM h) SELECT start, count(*) AS events FROM w GROUP BY start",
)
register(
    "until_cancelled",
    lambda s, d: progress.until_cancelled(_events(s, d).withColumn("at", F.struct("ts", "event_id")), "user_id", "at", F.col("event_type") == "error").select("event_id", "user_id"),
    """WITH c AS (SELECT event_id, user_id, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS c FROM events) SELECT event_id, user_id FROM c WHERE c = 0""",
)
