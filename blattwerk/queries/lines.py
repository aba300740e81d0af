"""Queries on the ordered lines of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blattwerk.functions import text as T
from blattwerk.operators import outline
from blattwerk.operators import sequences as S
from blattwerk.queries.quality import LINES
from blattwerk.queries.registry import register
from blattwerk.sources.pages import blocks, boxed, lines_of
from blattwerk.sources.tables import table

BOXED = (
    LINES
    + """, b AS (SELECT block_id, name, origin, CAST(seq AS INT) AS seq, text, CAST(80 + 420 * (seq % 2) + (seq % 7) * 3 AS INT) AS x0, CAST(60 + 20 * (seq // 2) AS INT) AS y0 FROM lines WHERE trim(text) <> ''),
boxed AS (SELECT *, CAST(x0 + least(400, 4 * length(text)) AS INT) AS x1, y0 + 14 AS y1 FROM b)"""
)


def _boxed(s: SparkSession, d: str) -> DataFrame:
    return boxed(lines_of(blocks(s, d)))


register(
    "pitch_median",
    lambda s, d: S.pitch(_boxed(s, d), "block_id", "y0", "seq"),
    f"WITH {BOXED}, p AS (SELECT block_id, lead(y0) OVER (PARTITION BY block_id ORDER BY seq) - y0 AS d FROM boxed) SELECT block_id, CAST(median(d) AS DOUBLE) AS pitch FROM p WHERE d > 0 AND d < 200 GROUP BY block_id",
)
register(
    "margin_median",
    lambda s, d: S.neighbour_median(_boxed(s, d), "block_id", "x0", "seq").select("block_id", "seq", "body"),
    f"""WITH {BOXED}, l AS (SELECT block_id, seq, list(x0) OVER (PARTITION BY block_id ORDER BY seq ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING EXCLUDE CURRENT ROW) AS v FROM boxed)
SELECT block_id, seq, CASE WHEN len(v) >= 4 THEN CAST(list_aggregate(v, 'median') AS DOUBLE) END AS body FROM l""",
)
register(
    "short_lines",
    lambda s, d: S.short_lines(_boxed(s, d), "block_id", "seq", "text").select("block_id", "seq", "block", "short"),
    f"""WITH {BOXED}, n AS (SELECT block_id, seq, text, x1, list(x1) OVER w AS r, list(x0) OVER w AS l, lead(text) OVER (PARTITION BY block_id ORDER BY seq) AS nx FROM boxed
  WINDOW w AS (PARTITION BY block_id ORDER BY seq ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING)),
m AS (SELECT *, CAST(list_aggregate(list_reverse_sort(r)[1:greatest(3, len(r) // 5)], 'median') AS DOUBLE) AS margin FROM n),
k AS (SELECT *, margin - list_min(l) AS width FROM m),
f AS (SELECT *, width > 0 AND len(list_filter(r, lambda x: x >= margin - 0.02 * width)) >= 0.55 * len(r) AS block FROM k)
SELECT block_id, seq, block, block AND x1 < margin - 0.08 * width AND NOT coalesce(regexp_matches(regexp_replace(nx, '^[*\\t\\n\\f\\r\\v ]+', ''), '^\\p{{Ll}}'), false) AS short FROM f""",
)
register(
    "short_texts",
    lambda s, d: S.short_texts(_boxed(s, d), "block_id", "text").where("short").select("block_id", "seq"),
    f"""WITH {BOXED}, m AS (SELECT block_id, seq, length(trim(text)) AS n, count(*) OVER (PARTITION BY block_id) AS k, median(length(trim(text))) OVER (PARTITION BY block_id) AS mid FROM boxed)
SELECT block_id, seq FROM m WHERE k >= 6 AND n < 0.95 * greatest(mid, 1.0)""",
)
register(
    "gap_sessions",
    lambda s, d: S.gap_sessions(table(s, d, "events"), ["user_id"], ["ts", "event_id"], F.expr("unix_micros(cast(ts as timestamp)) - unix_micros(cast(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) as timestamp)) > 1800000000")).select("event_id", "user_id", "session"),
    """WITH g AS (SELECT event_id, user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 1800000000 THEN 1 ELSE 0 END AS fresh FROM events)
SELECT event_id, user_id, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session FROM g""",
)
register(
    "anchor_sessions",
    lambda s, d: S.anchor_sessions(_boxed(s, d), ["block_id"], "y0", ["seq"], 45.0),
    f"""WITH RECURSIVE {BOXED}, o AS (SELECT block_id, y0, seq, row_number() OVER (PARTITION BY block_id ORDER BY y0, seq) AS rn FROM boxed),
f AS (SELECT block_id, y0, seq, rn, y0 AS anchor, 0 AS session FROM o WHERE rn = 1
  UNION ALL SELECT o.block_id, o.y0, o.seq, o.rn, CASE WHEN o.y0 - f.anchor > 45 THEN o.y0 ELSE f.anchor END, CASE WHEN o.y0 - f.anchor > 45 THEN f.session + 1 ELSE f.session END
  FROM f JOIN o ON o.block_id = f.block_id AND o.rn = f.rn + 1)
SELECT block_id, y0, seq, session FROM f""",
)
register(
    "line_islands",
    lambda s, d: S.islands(lines_of(blocks(s, d)), ["block_id"], "seq", F.trim("text") != ""),
    f"""WITH {LINES}, n AS (SELECT block_id, seq, text, row_number() OVER (PARTITION BY block_id ORDER BY seq) AS a FROM lines),
i AS (SELECT block_id, seq, a - row_number() OVER (PARTITION BY block_id ORDER BY seq) AS g FROM n WHERE trim(text) <> '')
SELECT block_id, CAST(min(seq) AS INT) AS first, CAST(max(seq) AS INT) AS last, count(*) AS length FROM i GROUP BY block_id, g""",
)
register(
    "longest_run",
    lambda s, d: S.longest_run(lines_of(blocks(s, d)), ["block_id"], "seq", F.col("text").rlike(r"\p{L}$")),
    f"""WITH {LINES}, n AS (SELECT block_id, seq, text, row_number() OVER (PARTITION BY block_id ORDER BY seq) AS a FROM lines),
i AS (SELECT block_id, a - row_number() OVER (PARTITION BY block_id ORDER BY seq) AS g FROM n WHERE regexp_matches(text, '\\p{{L}}$'))
SELECT block_id, max(k) AS longest FROM (SELECT block_id, g, count(*) AS k FROM i GROUP BY ALL) GROUP BY block_id""",
)
register(
    "line_repeat_trim",
    lambda s, d: S.trim_repeats(lines_of(blocks(s, d)).where(F.trim("text") != ""), "block_id", "seq", T.seam_key(F.col("text"))).select("block_id", "seq", "text"),
    f"""WITH {LINES}, k AS (SELECT block_id, seq, text, regexp_replace(lower(text), '[^0-9a-zäöüß]+', '', 'g') AS key FROM lines WHERE trim(text) <> ''),
n AS (SELECT *, CASE WHEN length(key) >= 8 AND key = lag(key) OVER (PARTITION BY block_id ORDER BY seq) THEN 0 ELSE 1 END AS fresh FROM k),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY block_id ORDER BY seq) AS run FROM n),
c AS (SELECT *, count(*) OVER (PARTITION BY block_id, run) AS k, row_number() OVER (PARTITION BY block_id, run ORDER BY seq) AS i FROM r)
SELECT block_id, CAST(seq AS INT) AS seq, text FROM c WHERE k < 3 OR i <= 2""",
)
register(
    "row_groups",
    lambda s, d: S.opened_rows(lines_of(blocks(s, d)), "block_id", "seq", F.col("text").rlike(r"^\s*(?:[-▪•]|\d{1,2}[.)])\s")).groupBy("block_id", "row_no").agg(F.count(F.lit(1)).alias("lines"), F.min("seq").alias("first")),
    f"""WITH {LINES}, r AS (SELECT block_id, seq, sum(CASE WHEN regexp_matches(text, '^[\\t ]*(?:[-▪•]|[0-9]{{1,2}}[.)])[\\t\\n\\f\\r\\v ]') THEN 1 ELSE 0 END) OVER (PARTITION BY block_id ORDER BY seq) AS row_no FROM lines)
SELECT block_id, CAST(row_no AS BIGINT) AS row_no, count(*) AS lines, CAST(min(seq) AS INT) AS first FROM r GROUP BY ALL""",
)
register(
    "sliding_sum",
    lambda s, d: S.sliding_sum(lines_of(blocks(s, d)).withColumn("ink", F.char_length("text")), ["block_id"], "seq", "ink", 3).select("block_id", "seq", "total"),
    f"""WITH {LINES}, w AS (SELECT block_id, seq, sum(length(text)) OVER x AS total, count(*) OVER x AS k FROM lines WINDOW x AS (PARTITION BY block_id ORDER BY seq ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING))
SELECT block_id, CAST(seq AS INT) AS seq, CAST(total AS BIGINT) AS total FROM w WHERE k = 3""",
)
register(
    "column_gap",
    lambda s, d: S.column_gap(_boxed(s, d), "block_id"),
    f"""WITH {BOXED}, x AS (SELECT block_id, x0, x1, count(*) OVER w AS n, max(x1) OVER w - min(x0) OVER w AS width FROM boxed WINDOW w AS (PARTITION BY block_id)),
k AS (SELECT *, x1 - x0 > 0.6 * width AS wide FROM x WHERE n >= 8 AND width > 0),
g AS (SELECT block_id, n, width, lead(x0) OVER (PARTITION BY block_id ORDER BY x0) - x0 AS gap, (x0 + lead(x0) OVER (PARTITION BY block_id ORDER BY x0)) / 2.0 AS position FROM (SELECT DISTINCT block_id, n, width, x0 FROM k)),
c AS (SELECT g.block_id, g.n, g.width, gap, position, count(*) FILTER (x0 < position) AS l, count(*) FILTER (NOT wide AND x0 < position AND x1 > position) AS crossings FROM g JOIN k USING (block_id) WHERE gap IS NOT NULL GROUP BY ALL)
SELECT block_id, CAST(arg_max(position, (-crossings, gap, -position)) AS DOUBLE) AS position FROM c
WHERE least(l, n - l) / n >= 0.25 AND (gap >= 0.25 * width OR (gap >= 0.08 * width AND crossings <= 0.02 * n)) GROUP BY block_id""",
)
register(
    "backward_jumps",
    lambda s, d: S.backward_jumps(_boxed(s, d).withColumn("h", (F.col("y0") * 7) % 400), "block_id", "seq", "h").select("block_id", "seq", "h"),
    f"WITH {BOXED}, h AS (SELECT block_id, seq, (y0 * 7) % 400 AS h, lag((y0 * 7) % 400) OVER (PARTITION BY block_id ORDER BY seq) AS l FROM boxed) SELECT block_id, seq, h FROM h WHERE h < l - 50",
)
register(
    "monotone_progress",
    lambda s, d: S.running_max(table(s, d, "events").withColumn("page", F.col("event_id") % 37), ["user_id"], ["ts", "event_id"], "page").where("page = reached").select("event_id", "user_id", "reached"),
    """WITH r AS (SELECT event_id, user_id, event_id % 37 AS page, max(event_id % 37) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS reached FROM events)
SELECT event_id, user_id, reached FROM r WHERE page = reached""",
)
register(
    "diagram_spread",
    lambda s, d: S.width_clusters(_boxed(s, d), "block_id"),
    f"""WITH {BOXED}, w AS (SELECT block_id, (x1 - x0) / 1000.0 AS width FROM boxed), g AS (SELECT block_id, width, CASE WHEN CAST(width AS DOUBLE) - lag(CAST(width AS DOUBLE)) OVER (PARTITION BY block_id ORDER BY width) > 0.05 THEN 1 ELSE 0 END AS fresh FROM w),
s AS (SELECT block_id, count(*) AS boxes, CAST(sum(fresh) + 1 AS BIGINT) AS clusters, round(stddev_pop(width), 9) AS spread FROM g GROUP BY block_id) SELECT *, boxes >= 3 AND clusters >= 3 AND spread >= 0.05 AS diagram FROM s""",
)
register(
    "edge_ratio",
    lambda s, d: S.edge_ratio(_boxed(s, d), "block_id", F.lit(0.5)),
    f"WITH {BOXED} SELECT block_id, CASE WHEN count(*) >= 20 THEN round(avg(CASE WHEN x1 / 1000 BETWEEN 0.35 AND 0.6 THEN 1.0 ELSE 0.0 END), 9) END AS ratio FROM boxed GROUP BY block_id",
)
register(
    "word_ngrams",
    lambda s, d: blocks(s, d).select(T.tokens(T.blind_digits(F.col("markdown"))).alias("w")).where(F.size("w") >= 5).select(F.explode(F.expr("transform(sequence(1, size(w) - 4), i -> array_join(slice(w, i, 5), ' '))")).alias("gram")).groupBy("gram").count().where("count >= 3"),
    """WITH blocks AS (SELECT DISTINCT ON (block_id) * FROM page_block), t AS (SELECT list_filter(string_split(trim(regexp_replace(regexp_replace(coalesce(markdown, ''), '[0-9]+', '#', 'g'), '[\\t\\n\\f\\r\\v ]+', ' ', 'g')), ' '), lambda w: w <> '') AS w FROM blocks),
g AS (SELECT array_to_string(w[i:i + 4], ' ') AS gram FROM t, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i) WHERE len(w) >= 5) SELECT gram, count(*) AS count FROM g GROUP BY gram HAVING count(*) >= 3""",
)
register(
    "half_loss",
    lambda s, d: _halves(s, d),
    """WITH blocks AS (SELECT DISTINCT ON (block_id) * FROM page_block), n AS (SELECT name, page_no, block_id, length(coalesce(markdown, '')) AS l, lead(length(coalesce(markdown, ''))) OVER (PARTITION BY name ORDER BY page_no, block_id) AS r,
  row_number() OVER (PARTITION BY name ORDER BY page_no, block_id) AS i FROM blocks) SELECT block_id, name, l, r FROM n WHERE i % 2 = 1 AND ((l > 150 AND r < 15) OR (r > 150 AND l < 15))""",
)


def _halves(s: SparkSession, d: str) -> DataFrame:
    """Pairs of successive pages of which one lost its text."""
    w = Window.partitionBy("name").orderBy("page_no", "block_id")
    n = F.char_length(F.coalesce("markdown", F.lit("")))
    p = blocks(s, d).select("block_id", "name", n.alias("l"), F.lead(n).over(w).alias("r"), F.row_number().over(w).alias("i"))
    return p.where("i % 2 = 1 AND ((l > 150 AND r < 15) OR (r > 150 AND l < 15))").select("block_id", "name", "l", "r")


register(
    "outline_starts",
    lambda s, d: lines_of(blocks(s, d)).where(outline.line_start(F.col("text"))).groupBy("block_id").agg(F.count(F.lit(1)).alias("starts"), F.min("seq").alias("first")),
    f"""WITH {LINES}, b AS (SELECT block_id, seq, text, regexp_replace(regexp_replace(text, '\\*+', '', 'g'), '^[\\t\\n\\f\\r\\v ]+', '') AS bare FROM lines),
t AS (SELECT * FROM b WHERE regexp_matches(bare, '^[\\t ]*(?:[-•·▪○●⇒⇨→➢✔]|\\(?[0-9]{{1,2}}[.)]|[a-z]{{1,3}}[.)]|[IVXL]{{1,5}}\\.)(?:[\\t\\n\\f\\r\\v ]|$)')
  OR (starts_with(text, '**') AND ends_with(text, '**') AND (length(text) - length(replace(text, '**', ''))) = 4 AND length(regexp_replace(text, '^\\*+[\\t ]*', '')) <= 90))
SELECT block_id, count(*) AS starts, CAST(min(seq) AS INT) AS first FROM t GROUP BY block_id""",
)
