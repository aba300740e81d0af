"""The history query."""

from __future__ import annotations

from blattwerk.operators import history
from blattwerk.queries.registry import register
from blattwerk.sources import table

_STATUS = "CASE {c} WHEN 'offen' THEN 'open' WHEN 'akzeptiert' THEN 'accepted' WHEN 'abgelehnt' THEN 'rejected' WHEN 'neu-erzeugt' THEN 're-created' WHEN 'uebernommen' THEN 'adopted' ELSE nullif(trim({c}), '') END"
_INSTANT = "coalesce(CAST(epoch_us(TRY_CAST(CASE WHEN regexp_matches({c}, '(Z|[+-][0-9]{{2}}:[0-9]{{2}})$') THEN {c} ELSE {c} || 'Z' END AS TIMESTAMPTZ)) AS VARCHAR), nullif(trim({c}), ''))"

register(
    "p4_found",
    lambda s, d: history.manifest_versions(table(s, d, "manifest")).select("name", "valid_from", "valid_to"),
    f"""
WITH held AS (
  SELECT name, updated,
    {_STATUS.format(c="status")} AS a,
    {_STATUS.format(c="previous.status")} AS b,
    {_INSTANT.format(c="previous.decided")} AS c,
    nullif(trim(previous.ocr_date), '') AS d,
    {_INSTANT.format(c="ocr_timestamp")} AS e,
    {_INSTANT.format(c="decided")} AS f
  FROM manifest
  WHERE name IS NOT NULL AND nullif(trim(updated), '') IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY name, updated ORDER BY loaded_at DESC NULLS LAST) = 1
), marked AS (
  SELECT *, lag(name) OVER w IS NULL OR a IS DISTINCT FROM lag(a) OVER w OR b IS DISTINCT FROM lag(b) OVER w
    OR c IS DISTINCT FROM lag(c) OVER w OR d IS DISTINCT FROM lag(d) OVER w
    OR e IS DISTINCT FROM lag(e) OVER w OR f IS DISTINCT FROM lag(f) OVER w AS fresh
  FROM held WINDOW w AS (PARTITION BY name ORDER BY updated)
)
SELECT name, updated AS valid_from,
  coalesce(lead(updated) OVER (PARTITION BY name ORDER BY updated), '9999-12-31T00:00:00') AS valid_to
FROM marked WHERE fresh
""",
)
