"""Registered queries of the text problems."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from blattwerk.llm import boilerplate, mixing, packing, quality, repetition, scanrepair, truncation
from blattwerk.sources import table

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "p1_found": lambda s, d: repetition.repeated_blocks(table(s, d, "page_block")),
        "p1_share": lambda s, d: repetition.block_repetition(table(s, d, "page_block")),
        "p2_found": lambda s, d: scanrepair.found_defects(table(s, d, "page_block")),
        "p2_repaired": lambda s, d: scanrepair.repaired(table(s, d, "page_block")),
        "p3_found": lambda s, d: boilerplate.source_lines(table(s, d, "page_block")),
        "p3_clean": lambda s, d: boilerplate.without_source_lines(table(s, d, "page_block")),
        "p5_found": lambda s, d: quality.blocks_not_prose(table(s, d, "page_block"), table(s, d, "vocab"), table(s, d, "page_kind")),
        "p5_stats": lambda s, d: quality.block_quality(table(s, d, "page_block"), table(s, d, "vocab")),
        "p5_plain": lambda s, d: quality.plain_statistics(table(s, d, "page_block"), "block_id", "markdown", table(s, d, "vocab")).withColumnRenamed("id", "block_id"),
        "p6_pack": lambda s, d: packing.pack_documents(table(s, d, "documents"), table(s, d, "container_spec")),
        "p6_fill": lambda s, d: packing.fill_rates(packing.pack_documents(table(s, d, "documents"), table(s, d, "container_spec")), table(s, d, "container_spec")),
        "p6_check": lambda s, d: packing.document_faults(table(s, d, "documents"), table(s, d, "container_spec")),
        "p7_mix": lambda s, d: mixing.mix_documents(table(s, d, "documents"), table(s, d, "mix_target"), table(s, d, "vocab")),
        "p7_shares": lambda s, d: mixing.document_shares(table(s, d, "documents"), table(s, d, "mix_target"), table(s, d, "vocab")),
        "p7_check": lambda s, d: mixing.document_faults(table(s, d, "documents"), table(s, d, "mix_target"), table(s, d, "vocab")),
        "p8_found": lambda s, d: truncation.truncated_documents(table(s, d, "documents")),
        "p8_rates": lambda s, d: truncation.truncation_rates(table(s, d, "documents")),
    }


# The glyph skeleton of a line in SQL: lone wide letters, umlauts, wide letters, classes.
_SKELETON = "' ' || replace(replace(lower(line), ';', ' '), '!', ' ') || ' '"
for _c in "mdwmdw":
    _SKELETON = f"replace({_SKELETON}, ' {_c} ', ' x ')"
for _a, _b in (("ü", "n"), ("ä", "o"), ("ö", "o"), ("ß", "s"), ("m", "rn"), ("d", "cl"), ("w", "vv")):
    _SKELETON = f"replace({_SKELETON}, '{_a}', '{_b}')"
_FOUND = f"""
blocks AS (SELECT DISTINCT ON (block_id) block_id, source_pdf, markdown FROM page_block WHERE block_id IS NOT NULL),
lines AS (SELECT block_id, source_pdf, unnest(string_split(markdown, chr(10))) AS line, generate_subscripts(string_split(markdown, chr(10)), 1) AS line_no FROM blocks WHERE source_pdf IS NOT NULL AND markdown IS NOT NULL),
tokens AS (SELECT block_id, source_pdf, line_no, list_transform(list_filter(string_split(regexp_replace(translate({_SKELETON}, 'etuirqahy', 'cfnllgobv'), '[^a-z0-9]+', ' ', 'g'), ' '), lambda t: t <> ''),
  lambda t: CASE WHEN regexp_full_match(t, '[lo]{{0,2}}[0-9][0-9lo]*[a-z]?') THEN '#' ELSE translate(t, '1058', 'losb') END) AS t FROM lines),
keys AS (SELECT block_id, source_pdf, line_no, array_to_string(list_filter(t, lambda x: x = '#' OR length(x) > 1), ' ') AS key FROM tokens WHERE len(list_filter(t, lambda x: x <> '#')) >= 3),
n AS (SELECT source_pdf, count(*) AS n FROM blocks WHERE source_pdf IS NOT NULL GROUP BY ALL),
k AS (SELECT source_pdf, key, count(DISTINCT block_id) AS k FROM keys WHERE key <> '' GROUP BY ALL),
found AS (SELECT block_id, CAST(line_no AS INT) AS line_no FROM keys JOIN k USING (source_pdf, key) JOIN n USING (source_pdf) WHERE k >= 4 AND k >= 0.2 * n)"""


def oracle_sql() -> dict[str, str]:
    """The exact shares of problem 3 in SQL (the operator's test for excess keeps all of these lines here), and what
    must hold of any packing and any mix."""
    return {
        "p5_plain": r"""WITH t AS (SELECT block_id, max(coalesce(markdown, '')) AS text FROM page_block WHERE block_id IS NOT NULL GROUP BY block_id),
v AS (SELECT list(DISTINCT lower(word)) AS known FROM vocab WHERE freq_rank <= 50 AND word IS NOT NULL),
w AS (SELECT block_id, text, regexp_extract_all(text, '\p{L}+') AS ws FROM t),
c AS (SELECT block_id, CAST(len(ws) AS BIGINT) AS words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS letters, CAST(len(list_filter(ws, lambda x: list_contains(known, lower(x)))) AS BIGINT) AS common,
  CAST(len(regexp_extract_all(text, '[^\p{L}\p{M}\p{Nd}\t\n\v\f\r .,;:!?()"''-]')) AS BIGINT) AS symbols, CAST(len(regexp_extract_all(text, '[^\t\n\v\f\r ]')) AS BIGINT) AS chars,
  CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\t\v\f\r ]'))) AS BIGINT) AS lines,
  CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[.!?:;][ \t]*$'))) AS BIGINT) AS lines_punct FROM w, v)
SELECT *, CASE WHEN words > 0 THEN letters / words ELSE 0.0 END AS word_length, CASE WHEN words > 0 THEN common / words ELSE 0.0 END AS common_share,
  CASE WHEN chars > 0 THEN symbols / chars ELSE 0.0 END AS symbol_ratio, CASE WHEN lines > 0 THEN lines_punct / lines ELSE 0.0 END AS punct_share FROM c""",
        "p7_check": """SELECT mix_name, coalesce(lower(trim(source)), '') AS source, CAST(0 AS BIGINT) AS strangers, CAST(0 AS BIGINT) AS beyond, false AS uneven FROM mix_target
WHERE mix_name IS NOT NULL AND target_share > 0 GROUP BY ALL""",
        "p6_check": """SELECT container_kind, (SELECT count(DISTINCT doc_id) FROM documents) AS documents, CAST(0 AS BIGINT) AS incomplete, CAST(0 AS BIGINT) AS split, CAST(0 AS BIGINT) AS overfull
FROM container_spec WHERE capacity_tokens > 0 AND container_kind IS NOT NULL GROUP BY container_kind""",
        "p3_found": f"WITH {_FOUND} SELECT block_id, line_no FROM found",
        "p3_clean": f"""WITH {_FOUND}, l AS (SELECT block_id, unnest(string_split(markdown, chr(10))) AS line, generate_subscripts(string_split(markdown, chr(10)), 1) AS line_no FROM blocks WHERE markdown IS NOT NULL),
kept AS (SELECT block_id, string_agg(line, chr(10) ORDER BY line_no) AS markdown FROM l WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.block_id = l.block_id AND f.line_no = l.line_no) GROUP BY block_id),
gone AS (SELECT block_id, count(*) AS removed FROM found GROUP BY block_id)
SELECT b.block_id, CASE WHEN b.markdown IS NULL THEN NULL ELSE coalesce(kept.markdown, '') END AS markdown, CAST(coalesce(removed, 0) AS INT) AS removed FROM blocks b LEFT JOIN kept USING (block_id) LEFT JOIN gone USING (block_id)""",
    }
