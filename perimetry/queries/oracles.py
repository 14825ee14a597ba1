"""The registered queries in DuckDB SQL over the same tables, written independently of the library."""

from __future__ import annotations

from perimetry.config import SOURCES
from perimetry.queries.adapter import oracle_a
from perimetry.queries.roundtrips import LOOKED_UP, SOME_IDS

_SHAPES = """CASE
  WHEN regexp_full_match(s, '\\d{14}') THEN try_strptime(s, '%Y%m%d%H%M%S')
  WHEN regexp_full_match(s, '\\d{8}') THEN try_strptime(s, '%Y%m%d')
  WHEN regexp_full_match(s, '\\d{4}-\\d\\d-\\d\\d') THEN try_strptime(s, '%Y-%m-%d')
  WHEN regexp_full_match(s, '\\d{4}-\\d\\d-\\d\\d \\d\\d:\\d\\d:\\d\\d') THEN try_strptime(s, '%Y-%m-%d %H:%M:%S')
  WHEN regexp_full_match(s, '\\d{4}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d') THEN try_strptime(s, '%Y-%m-%dT%H:%M:%S')
  WHEN regexp_full_match(s, '\\d{4}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\dZ') THEN try_strptime(s, '%Y-%m-%dT%H:%M:%SZ')
  WHEN regexp_full_match(s, '\\d{4}-\\d\\d-\\d\\d \\d\\d:\\d\\d:\\d\\d\\+05:00')
    THEN try_strptime(left(s, 19), '%Y-%m-%d %H:%M:%S') - INTERVAL 5 HOUR
  WHEN regexp_full_match(s, '\\d\\d/\\d\\d/\\d{4}( \\d\\d:\\d\\d:\\d\\d(\\.\\d+)?)?')
    THEN coalesce(try_strptime(s, '%m/%d/%Y'), try_strptime(s, '%m/%d/%Y %H:%M:%S'), try_strptime(s, '%m/%d/%Y %H:%M:%S.%f'))
END""".replace("\\\\", "\\")


def _parsed(column: str) -> str:
    """Text column -> timestamp within the nanosecond span."""
    shapes = _SHAPES.replace("(s,", f"({column},").replace("left(s,", f"left({column},")
    return (
        f"(SELECT CASE WHEN t BETWEEN TIMESTAMP '1677-09-21 00:12:43.145225' AND"
        f" TIMESTAMP '2262-04-11 23:47:16.854775' THEN t END FROM (SELECT {shapes} AS t))"
    )


def _ok(c: str) -> str:
    return f"coalesce(lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')) NOT IN ('none', 'nan', '', 'null'), false)"


def _stripped(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


_LOCAL = (
    f"{_ok('local_incident_id')} AND coalesce(fire_year NOT IN ('', '0'), false)"
    " AND coalesce(unit_id NOT IN ('', '0'), false)"
)

# One CTE per step of the unify job.
CTES = f"""
a AS ({oracle_a()}),
d AS (SELECT a.*, record_no AS row_id, {_parsed('perimeter_date_raw')} AS perimeter_date FROM a),
y AS (SELECT * REPLACE (coalesce(regexp_replace(fire_year, '^(-?\\d+)\\.0+$', '\\1'),
    CAST(year(perimeter_date) AS VARCHAR)) AS fire_year),
  fire_year IS NULL AND perimeter_date IS NOT NULL AS year_filled FROM d),
i AS (SELECT *,
  CASE WHEN {_ok('incident_id_raw')} THEN 'formal' WHEN {_ok('irwin_id_raw')} THEN 'irwin'
    WHEN {_LOCAL} THEN 'local' WHEN {_ok('for_id')} THEN 'for_id' WHEN {_ok('geo_id')} THEN 'geo_id'
    WHEN {_ok('global_id')} THEN 'global_id' ELSE 'none' END AS id_type,
  CASE WHEN {_ok('incident_id_raw')} THEN {_stripped('incident_id_raw')}
    WHEN {_ok('irwin_id_raw')} THEN {_stripped('irwin_id_raw')}
    WHEN {_LOCAL} THEN fire_year || '-' || unit_id || '-' || local_incident_id
    WHEN {_ok('for_id')} THEN {_stripped('for_id')} WHEN {_ok('geo_id')} THEN {_stripped('geo_id')}
    WHEN {_ok('global_id')} THEN {_stripped('global_id')} END AS incident_id FROM y),
q AS (SELECT *, CASE WHEN id_type = 'none' THEN 'no_id'
    WHEN perimeter_date IS NOT NULL AND year(perimeter_date) NOT BETWEEN 1900 AND 2027 THEN 'invalid_date'
    WHEN incident_name IS NULL OR incident_name IN ('', 'None') THEN 'missing_incident_name'
    WHEN fire_year IS NULL OR fire_year IN ('', 'None') THEN 'missing_fire_year'
    WHEN geom_kind = 'null' THEN 'missing_geometry'
    WHEN geom_kind = 'bowtie' THEN 'invalid_geometry' END AS reject_reason FROM i),
k AS (SELECT * FROM q WHERE reject_reason IS NULL QUALIFY row_number() OVER (
    PARTITION BY incident_id, fire_year, CASE WHEN geom_kind = 'box' THEN cx END, CASE WHEN geom_kind = 'box' THEN cy END
    ORDER BY CASE source_dataset WHEN 'Interagency Fire Perimeter History' THEN 1
      WHEN 'Historic GeoMAC (2000-2018)' THEN 2 WHEN 'WFIGS Recent (2016-2025)' THEN 3
      WHEN 'WFIGS Year to Date' THEN 4 WHEN 'WFIGS Current' THEN 5 ELSE 99 END, row_id) = 1),
u AS (SELECT row_id, incident_id, incident_name, CASE WHEN regexp_full_match(fire_year, '\\d+') THEN CAST(fire_year AS DOUBLE) END AS fire_year,
  unit_id, perimeter_date, source_dataset, id_type, geom_kind, cx, cy, half FROM k)
"""

# Consecutive distinct moments of an incident in `u`, with the last and first record of each.
LINKS = """
m AS (SELECT incident_id, perimeter_date AS ts, min(row_id) AS first_row, max(row_id) AS last_row
  FROM u WHERE perimeter_date IS NOT NULL GROUP BY ALL),
l AS (SELECT * FROM (SELECT incident_id, ts AS curr_ts, last_row AS curr_row,
  lead(ts) OVER w AS next_ts, lead(first_row) OVER w AS next_row FROM m
  WINDOW w AS (PARTITION BY incident_id ORDER BY ts)) WHERE next_row IS NOT NULL),
p AS (SELECT * FROM l WHERE epoch(next_ts) - epoch(curr_ts) < 604800)
"""

# Both boxes of each consecutive pair.
BOXES = """
b AS (SELECT l.*, c.geom_kind = 'box' AND n.geom_kind = 'box' AS boxes,
  c.cx - c.half AS ax1, c.cx + c.half AS ax2, c.cy - c.half AS ay1, c.cy + c.half AS ay2,
  n.cx - n.half AS bx1, n.cx + n.half AS bx2, n.cy - n.half AS by1, n.cy + n.half AS by2
  FROM l JOIN u c ON c.row_id = curr_row JOIN u n ON n.row_id = next_row)
"""
_MEET = "boxes AND ax1 <= bx2 AND bx1 <= ax2 AND ay1 <= by2 AND by1 <= ay2"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes) + "\n"


_A = _with(CTES)
_TEXTS = (
    "incident_id_raw, irwin_id_raw, local_incident_id, for_id, geo_id, global_id, incident_name,"
    " fire_year, unit_id, CAST(NULL AS VARCHAR) AS state, perimeter_date_raw"
)

# Closed ring of 32 points of each embedding, its segments, and its area sums.
_RINGS = """
pt AS (SELECT vec_id, i, CAST(embedding[2 * i + 1] AS DOUBLE) AS x, CAST(embedding[2 * i + 2] AS DOUBLE) AS y
  FROM embeddings, range(32) t(i)),
sg AS (SELECT p.vec_id, p.i, p.x AS x1, p.y AS y1, q.x AS x2, q.y AS y2
  FROM pt p JOIN pt q ON p.vec_id = q.vec_id AND q.i = (p.i + 1) % 32)
"""


def _funnel(table: str, key: str, ts: str) -> str:
    """CTE `f`: the funnel counters, by row-wise neighbours in date order."""
    return f"""
o AS (SELECT {key} AS k, {ts} AS t, lag({ts}) OVER (PARTITION BY {key} ORDER BY {ts}) AS before FROM {table}),
g AS (SELECT k, count(*) AS n, bool_and(t IS NOT NULL) AS dated,
  count(*) FILTER (WHERE before = t) AS same, count(*) FILTER (WHERE before <> t) AS diff,
  count(*) FILTER (WHERE before <> t AND date_diff('day', before, t) <= 6) AS near FROM o WHERE k IS NOT NULL GROUP BY k),
f AS (SELECT (SELECT count(*) FROM o) AS perimeters, count(*) AS incidents,
  count(*) FILTER (WHERE n = 1) AS single_incidents, count(*) FILTER (WHERE n > 1) AS multi_incidents,
  coalesce(sum(n - 1) FILTER (WHERE n > 1), 0)::BIGINT AS multi_pairs,
  count(*) FILTER (WHERE n > 1 AND dated) AS dated_incidents,
  coalesce(sum(n - 1) FILTER (WHERE n > 1 AND dated), 0)::BIGINT AS dated_pairs,
  coalesce(sum(same) FILTER (WHERE n > 1 AND dated), 0)::BIGINT AS same_timestamp_pairs,
  count(*) FILTER (WHERE n > 1 AND dated AND diff > 0) AS distinct_incidents,
  coalesce(sum(diff) FILTER (WHERE n > 1 AND dated), 0)::BIGINT AS distinct_pairs,
  coalesce(sum(diff - near) FILTER (WHERE n > 1 AND dated), 0)::BIGINT AS long_gap_pairs,
  count(*) FILTER (WHERE n > 1 AND dated AND near > 0) AS usable_incidents,
  coalesce(sum(near) FILTER (WHERE n > 1 AND dated), 0)::BIGINT AS usable_pairs,
  round(100 * count(*) FILTER (WHERE n > 1 AND dated AND near > 0) / count(*), 1) AS usable_percent FROM g)
"""


def _timeline(key: str, more: str = "", join: str = "") -> str:
    """From CTE `p` (pairs): items, positions, labels."""
    return f"""
t AS (SELECT {key}, curr_ts AS ts, curr_row AS "row" FROM p UNION ALL
  SELECT {key}, arg_max(next_ts, curr_ts), arg_max(next_row, curr_ts) FROM p GROUP BY {key}),
z AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ts) - 1 AS position,
  count(*) OVER (PARTITION BY {key}) AS perimeters FROM t),
v AS (SELECT *, position % greatest(1, perimeters // 15) = 0 OR position = perimeters - 1 AS is_label FROM z)
SELECT v.{key}, CAST(ts AS VARCHAR) AS ts, "row", position, perimeters,
  round(position / greatest(perimeters - 1, 1), 6) AS progress, is_label,
  strftime(ts, '%m/%d') AS label{more} FROM v {join}"""


_ROSTER = f"""
e AS (SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN '2024-' || user_id END AS incident_id,
  CASE WHEN event_id % 3 <> 0 THEN event_type || ' by user ' || user_id || ' on a long-named ridge' END AS name,
  CASE WHEN event_id % 4 <> 0 THEN ts END AS start, value * 1000 AS acres FROM events),
r AS (SELECT incident_id, arg_min(name, event_id) FILTER (WHERE name IS NOT NULL) AS fire_name,
  arg_min(start, event_id) FILTER (WHERE start IS NOT NULL) AS fire_start, max(acres) AS max_acres
  FROM e WHERE incident_id IS NOT NULL GROUP BY incident_id)
"""

_PART_LINKS = """
m AS (SELECT l_partkey, l_shipdate AS ts, min(l_orderkey * 8 + l_linenumber) AS first_row,
  max(l_orderkey * 8 + l_linenumber) AS last_row FROM lineitem GROUP BY ALL),
l AS (SELECT l_partkey, ts AS curr_ts, last_row AS curr_row, lead(ts) OVER w AS next_ts, lead(first_row) OVER w AS next_row
  FROM m WINDOW w AS (PARTITION BY l_partkey ORDER BY ts))
"""


def _pair_counts(table: str, key: str, ts: str) -> str:
    return f"""
o AS (SELECT {key}, {ts} AS t, lag({ts}) OVER (PARTITION BY {key} ORDER BY {ts} NULLS FIRST) AS before FROM {table}),
c AS (SELECT {key}, count(*) AS perimeters, count(*) FILTER (WHERE t IS NULL) AS undated,
  count(DISTINCT t) AS moments, count(*) FILTER (WHERE before = t) AS same_timestamp,
  count(*) FILTER (WHERE before <> t AND date_diff('day', before, t) <= 6) AS calendar_pairs,
  count(*) FILTER (WHERE before <> t AND epoch(t) - epoch(before) < 604800) AS elapsed_pairs FROM o GROUP BY {key})
"""


_UNIFIED_COLUMNS = (
    "row_id, incident_id, incident_name, fire_year, unit_id, CAST(perimeter_date AS VARCHAR) AS perimeter_date,"
    " source_dataset, id_type, CASE WHEN geom_kind = 'box' THEN 5 ELSE 0 END AS points"
)

ORACLES: dict[str, str] = {
    # The year-to-date source names its id like no alias; the unlisted one has its name field
    # under an output name and a second unit field that normalizes like the first and comes earlier.
    "q01_normalize_schema": f"WITH a AS ({oracle_a()}) SELECT record_no AS row_id, source_dataset,"
    " CASE WHEN source_dataset <> 'WFIGS Year to Date' THEN incident_id_raw END AS incident_id_raw,"
    " irwin_id_raw, local_incident_id, for_id, geo_id, global_id,"
    " CASE WHEN source_dataset <> 'Unlisted source' THEN incident_name END AS incident_name,"
    " fire_year, unit_id, CAST(NULL AS VARCHAR) AS state, perimeter_date_raw FROM a",
    "q02_valid_id": f"WITH a AS ({oracle_a()}) SELECT record_no AS row_id, "
    + ", ".join(
        f"{_ok(c)} AS {c}_ok"
        for c in ("incident_id_raw", "irwin_id_raw", "local_incident_id", "for_id", "geo_id", "global_id")
    )
    + " FROM a",
    "q03_unify_id": _A + "SELECT row_id, id_type, incident_id FROM i",
    "q04_parse_date": _A + "SELECT row_id, CAST(perimeter_date AS VARCHAR) AS perimeter_date FROM d",
    "q05_year_fill": _A + "SELECT row_id, fire_year, year_filled FROM y",
    "q06_quality_reasons": _A
    + "SELECT coalesce(reject_reason, 'passed') AS reason, count(*) AS records FROM q GROUP BY ALL",
    "q07_rejects_no_id": _A + f"SELECT row_id, {_TEXTS}, source_dataset,"
    " CAST(perimeter_date AS VARCHAR) AS perimeter_date, id_type, incident_id FROM q WHERE id_type = 'none'",
    "q08_centroid": f"WITH a AS ({oracle_a()}) SELECT record_no AS row_id,"
    " CASE WHEN geom_kind IN ('box', 'bowtie') THEN cx END AS x,"
    " CASE WHEN geom_kind IN ('box', 'bowtie') THEN cy END AS y,"
    " geom_kind IN ('null', 'empty') AS no_geom FROM a",
    "q08_centroid_rings": _with(_RINGS) + "SELECT vec_id,"
    " round(ox + sum(c * (x1 + x2 - 2 * ox)) / (3 * sum(c)), 6) AS x,"
    " round(oy + sum(c * (y1 + y2 - 2 * oy)) / (3 * sum(c)), 6) AS y"
    " FROM (SELECT sg.*, o.x AS ox, o.y AS oy, (x1 - o.x) * (y2 - o.y) - (x2 - o.x) * (y1 - o.y) AS c"
    " FROM sg JOIN pt o ON o.vec_id = sg.vec_id AND o.i = 0) GROUP BY vec_id, ox, oy",
    "q09_validity": f"WITH a AS ({oracle_a()}) SELECT record_no AS row_id,"
    " CASE geom_kind WHEN 'null' THEN 'missing' WHEN 'bowtie' THEN 'invalid' ELSE 'valid' END AS verdict FROM a",
    "q09_validity_rings": _with(_RINGS) + """, x AS (SELECT DISTINCT p.vec_id FROM sg p JOIN sg q ON p.vec_id = q.vec_id
  AND q.i > p.i + 1 AND NOT (p.i = 0 AND q.i = 31)
  AND ((p.x2 - p.x1) * (q.y1 - p.y1) - (p.y2 - p.y1) * (q.x1 - p.x1)) * ((p.x2 - p.x1) * (q.y2 - p.y1) - (p.y2 - p.y1) * (q.x2 - p.x1)) <= 0
  AND ((q.x2 - q.x1) * (p.y1 - q.y1) - (q.y2 - q.y1) * (p.x1 - q.x1)) * ((q.x2 - q.x1) * (p.y2 - q.y1) - (q.y2 - q.y1) * (p.x2 - q.x1)) <= 0)
SELECT vec_id, vec_id NOT IN (SELECT vec_id FROM x) AS valid FROM embeddings""",
    "q10_dedup": _A + "SELECT row_id, incident_id, fire_year, source_dataset FROM k",
    "q11_unified_table": _A + f"SELECT {_UNIFIED_COLUMNS} FROM u",
    "q12_dataset_counts": f"WITH a AS ({oracle_a()}) SELECT source_dataset, count(*) AS raw_count FROM a GROUP BY ALL",
    "q13_id_type_distribution": _A + "SELECT id_type, count(*) AS records,"
    " round(100 * count(*) / sum(count(*)) OVER (), 1) AS percent FROM i GROUP BY id_type",
    "q14_overall_report": _A + """, s AS (SELECT incident_id, count(*) AS n FROM u GROUP BY ALL),
c AS (SELECT count(*) FILTER (WHERE id_type <> 'none') AS total_input,
  count(*) FILTER (WHERE reject_reason LIKE 'missing%') AS missing_required_fields,
  count(*) FILTER (WHERE reject_reason = 'invalid_date') AS invalid_dates,
  count(*) FILTER (WHERE reject_reason = 'invalid_geometry') AS invalid_geometry,
  count(*) FILTER (WHERE reject_reason IS NULL) AS passed, count(*) FILTER (WHERE year_filled) AS years_filled,
  count(*) FILTER (WHERE id_type = 'formal') AS formal_ids,
  count(*) FILTER (WHERE source_dataset = 'WFIGS Year to Date') AS year_to_date_records FROM q),
w AS (SELECT count(*) AS total_records, count(DISTINCT incident_id) AS unique_incidents,
  CAST(min(perimeter_date) AS VARCHAR) AS min_date, CAST(max(perimeter_date) AS VARCHAR) AS max_date,
  CAST(min(fire_year) AS INTEGER) AS min_year, CAST(max(fire_year) AS INTEGER) AS max_year FROM u)
SELECT w.*, c.*, passed - total_records AS duplicates_removed,
  (SELECT count(*) FROM s WHERE n = 1) AS single_perimeter_incidents,
  (SELECT count(*) FROM s WHERE n > 1) AS multi_perimeter_incidents,
  (SELECT max(n) FROM s) AS max_perimeters, (SELECT round(avg(n), 6) FROM s) AS avg_perimeters_per_incident FROM w, c""",
    "q15_incident_stats": "SELECT count(*) AS total_incidents, count(*) FILTER (WHERE n = 1) AS single_perimeter_incidents,"
    " count(*) FILTER (WHERE n > 1) AS multi_perimeter_incidents, round(avg(n), 6) AS avg_perimeters_per_incident,"
    " max(n) AS max_perimeters FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL)",
    "q16_funnel": _with(_funnel("orders", "o_custkey", "o_orderdate")) + "SELECT * FROM f",
    "q16_funnel_steps": _with(_funnel("orders", "o_custkey", "o_orderdate"))
    + """SELECT 0 AS step, NULL::BIGINT AS incidents_before, NULL::BIGINT AS incidents_removed, incidents AS incidents_after,
  NULL::BIGINT AS pairs_before, NULL::BIGINT AS pairs_removed, NULL::BIGINT AS pairs_after FROM f
UNION ALL SELECT 1, incidents, single_incidents, multi_incidents, NULL, NULL, multi_pairs FROM f
UNION ALL SELECT 2, multi_incidents, multi_incidents - dated_incidents, dated_incidents, multi_pairs, multi_pairs - dated_pairs, dated_pairs FROM f
UNION ALL SELECT 3, dated_incidents, dated_incidents - distinct_incidents, distinct_incidents, dated_pairs, same_timestamp_pairs, distinct_pairs FROM f
UNION ALL SELECT 4, distinct_incidents, distinct_incidents - usable_incidents, usable_incidents, distinct_pairs, long_gap_pairs, usable_pairs FROM f""",
    "q17_funnel_with_missing_dates": _with(CTES, _funnel("u", "incident_id", "perimeter_date")) + "SELECT * FROM f",
    "q18_pairs_elapsed": _with(CTES, LINKS)
    + "SELECT * REPLACE (CAST(curr_ts AS VARCHAR) AS curr_ts, CAST(next_ts AS VARCHAR) AS next_ts) FROM p",
    "q19_pairs_calendar": _with(CTES, LINKS)
    + "SELECT * REPLACE (CAST(curr_ts AS VARCHAR) AS curr_ts, CAST(next_ts AS VARCHAR) AS next_ts) FROM l"
    " WHERE date_diff('day', curr_ts, next_ts) <= 6",
    "q20_gap_rule_difference": _with(CTES, _pair_counts("u", "incident_id", "perimeter_date"))
    + "SELECT incident_id, perimeters, elapsed_pairs, calendar_pairs FROM c WHERE elapsed_pairs <> calendar_pairs",
    "q21_bbox_overlap_pairs": _with(CTES, LINKS, BOXES)
    + f"SELECT incident_id, curr_row, next_row, {_MEET} AS bbox_overlap FROM b",
    "q22_overlap_count": _with(CTES, LINKS, BOXES)
    + f"SELECT count(*) AS pairs, count(*) FILTER (WHERE {_MEET}) AS overlapping FROM b"
    " WHERE epoch(next_ts) - epoch(curr_ts) < 604800",
    "q22_overlap_pairs": _with(CTES, LINKS, BOXES)
    + f"SELECT incident_id, curr_row, next_row, {_MEET} AS overlaps FROM b",
    "q23_contains_pairs": _with(CTES, LINKS, BOXES) + """SELECT incident_id, curr_row, next_row,
  boxes AND ax1 <= bx1 AND bx2 <= ax2 AND ay1 <= by1 AND by2 <= ay2 AS curr_contains,
  boxes AND bx1 <= ax1 AND ax2 <= bx2 AND by1 <= ay1 AND ay2 <= by2 AS next_contains FROM b""",
    "q24_sequences": _with(CTES, _pair_counts("u", "incident_id", "perimeter_date"))
    + "SELECT incident_id, perimeters, elapsed_pairs AS pairs FROM c WHERE perimeters > 1",
    "q25_timeline": _with(CTES, LINKS)
    + ","
    + _timeline(
        "incident_id",
        ", CASE WHEN is_label AND geom_kind = 'box' THEN cx END AS x, CASE WHEN is_label AND geom_kind = 'box' THEN cy END AS y",
        'JOIN u ON u.row_id = v."row"',
    ),
    "q25_timeline_summary": _with(CTES, LINKS) + """, s AS (SELECT incident_id, min(curr_ts)::DATE AS f, max(next_ts)::DATE AS t,
  count(*) AS training_pairs, count(*) + 1 AS perimeters, arg_min(curr_row, curr_ts) AS first_row FROM p GROUP BY ALL)
SELECT s.incident_id, CAST(f AS VARCHAR) AS first_date, CAST(t AS VARCHAR) AS last_date, training_pairs, perimeters, incident_name,
  incident_name || ' (' || s.incident_id || ')' || chr(10) || 'Perimeter Growth: ' || f || ' to ' || t || chr(10)
    || training_pairs || ' training pairs, ' || perimeters || ' unique perimeters' AS title
FROM s JOIN u ON u.row_id = s.first_row""",
    "q25_timeline_events": """WITH p AS (SELECT * FROM (SELECT user_id, ts AS curr_ts, event_id AS curr_row,
  lead(ts) OVER w AS next_ts, lead(event_id) OVER w AS next_row FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE next_ts <> curr_ts AND epoch(next_ts) - epoch(curr_ts) < 604800),"""
    + _timeline("user_id"),
    "q26_roster": _with(_ROSTER)
    + "SELECT incident_id, fire_name, CAST(fire_start AS VARCHAR) AS fire_start, round(max_acres, 3) AS max_acres FROM r",
    "q27_roster_report": _with(_ROSTER) + """SELECT incident_id, concat_ws(' ', rpad(coalesce(fire_name, 'Unknown'), 40, ' '),
  rpad(coalesce(strftime(fire_start, '%Y-%m-%d'), 'Unknown'), 12, ' '), rpad(incident_id, 30, ' '),
  rpad(coalesce(format('{:,.0f}', max_acres), 'Unknown'), 12, ' ')) AS line FROM r""",
    "q28_pairs_lineitem": _with(_PART_LINKS) + """SELECT l_partkey, count(*) AS distinct_pairs,
  count(*) FILTER (WHERE near) AS near_pairs, sum(curr_row) FILTER (WHERE near)::BIGINT AS curr_rows,
  sum(next_row) FILTER (WHERE near)::BIGINT AS next_rows
FROM (SELECT *, epoch(next_ts) - epoch(curr_ts) < 604800 AS near FROM l WHERE next_row IS NOT NULL) GROUP BY l_partkey""",
    "q28_pair_counts_lineitem": _with(_pair_counts("lineitem", "l_partkey", "l_shipdate")) + "SELECT * FROM c",
    "q29_shapefile_roundtrip": f"WITH a AS ({oracle_a()}) SELECT CASE source_dataset WHEN 'Unlisted source' THEN 'WFIGS Current'"
    " ELSE source_dataset END AS source_dataset, "
    + ", ".join(
        f"nullif(trim({c}), '') AS {c}"
        for c in (
            "incident_id_raw", "irwin_id_raw", "local_incident_id", "for_id", "geo_id", "global_id",
            "incident_name", "fire_year", "unit_id", "perimeter_date_raw",
        )
    )
    + ", CASE geom_kind WHEN 'null' THEN -1 WHEN 'empty' THEN 0 ELSE 5 END AS points,"
    " CASE WHEN geom_kind IN ('box', 'bowtie') THEN cx - half END AS xmin,"
    " CASE WHEN geom_kind IN ('box', 'bowtie') THEN cx + half END AS xmax,"
    " CASE geom_kind WHEN 'null' THEN -1 WHEN 'empty' THEN 0 ELSE 4 END AS corners FROM a",
    "q30_sinks_roundtrip": _A + f"SELECT {_UNIFIED_COLUMNS}, CASE WHEN geom_kind = 'box' THEN cy + half END AS ymax,"
    " CASE WHEN geom_kind = 'box' THEN cx - half END AS xmin, 4326 AS srid FROM u",
}
for _name in ("q38_staged_archives", "q39_split_files"):  # the same records, read in other pieces
    ORACLES[_name] = ORACLES["q29_shapefile_roundtrip"]
# the file of refused records keeps every column
ORACLES["q30_rejects_roundtrip"] = ORACLES["q07_rejects_no_id"]

# every other ring in the order of its points' angles
_TURNED = _RINGS.replace(
    "pt AS (", "raw AS (", 1
).replace("sg AS (", """pt AS (SELECT vec_id, x, y,
  row_number() OVER (PARTITION BY vec_id ORDER BY CASE WHEN vec_id % 2 = 0 THEN atan2(y, x) ELSE i END, x, y) - 1 AS i FROM raw),
sg AS (""", 1)
ORACLES["q09_validity_by_angle"] = ORACLES["q09_validity_rings"].replace(_with(_RINGS), _with(_TURNED))


def _side(point: str, segment: str) -> str:
    x, y = {"": ("x", "y"), "1": ("x1", "y1"), "2": ("x2", "y2")}[point[1:]]
    s, p = segment, point[0]
    return f"(({s}.x2 - {s}.x1) * ({p}.{y} - {s}.y1) - ({s}.y2 - {s}.y1) * ({p}.{x} - {s}.x1))"


def _triangle(name: str, first: int, scale: str) -> str:
    return f"""p{name} AS (SELECT vec_id, i, CAST(embedding[2 * i + {first}] AS DOUBLE) * {scale} AS x,
  CAST(embedding[2 * i + {first + 1}] AS DOUBLE) * {scale} AS y FROM embeddings, range(3) t(i)),
s{name} AS (SELECT p.vec_id, p.i, p.x AS x1, p.y AS y1, q.x AS x2, q.y AS y2
  FROM p{name} p JOIN p{name} q ON p.vec_id = q.vec_id AND q.i = (p.i + 1) % 3),
x{name} AS (SELECT vec_id, min(x) AS x1, max(x) AS x2, min(y) AS y1, max(y) AS y2 FROM p{name} GROUP BY vec_id)"""


def _inside(name: str, inner: str, outer: str) -> str:
    """Corners of one triangle that lie on one side of all segments of the other."""
    return f"""{name} AS (SELECT vec_id, bool_or(inside) AS some, bool_and(inside) AS whole FROM (
  SELECT q.vec_id, q.i, min({_side("q", "p")}) >= 0 OR max({_side("q", "p")}) <= 0 AS inside
  FROM p{inner} q JOIN s{outer} p ON q.vec_id = p.vec_id GROUP BY q.vec_id, q.i) GROUP BY vec_id)"""


ORACLES["q35_triangles"] = "WITH " + ", ".join([
    _triangle("a", 1, "1"), _triangle("b", 7, "0.25"), _inside("b_in_a", "b", "a"), _inside("a_in_b", "a", "b"),
    f"""crossing AS (SELECT DISTINCT p.vec_id FROM sa p JOIN sb q ON p.vec_id = q.vec_id
  WHERE {_side("q1", "p")} * {_side("q2", "p")} <= 0 AND {_side("p1", "q")} * {_side("p2", "q")} <= 0)""",
]) + """
SELECT e.vec_id, xa.x1 <= xb.x2 AND xb.x1 <= xa.x2 AND xa.y1 <= xb.y2 AND xb.y1 <= xa.y2 AS boxes_meet,
  b_in_a.some OR a_in_b.some OR e.vec_id IN (SELECT vec_id FROM crossing) AS overlaps, b_in_a.whole AS a_contains_b
FROM embeddings e JOIN xa ON xa.vec_id = e.vec_id JOIN xb ON xb.vec_id = e.vec_id
  JOIN b_in_a ON b_in_a.vec_id = e.vec_id JOIN a_in_b ON a_in_b.vec_id = e.vec_id"""

# the files hold texts without outer blanks, no empty ones, and unlisted records as records of the last source
_STORED = ", ".join(f"nullif(trim({c}), '') AS {c}" for c in (
    "incident_id_raw", "irwin_id_raw", "local_incident_id", "for_id", "geo_id", "global_id",
    "incident_name", "fire_year", "unit_id", "perimeter_date_raw",
))
_FILED = _A.replace(oracle_a(), f"SELECT * REPLACE ({_STORED}) FROM ({oracle_a()})").replace("'Unlisted source'", f"'{SOURCES[-1].name}'")
ORACLES["q31_unify_job"] = _FILED + "SELECT incident_id, fire_year, source_dataset, id_type, 4326 AS srid FROM u"
ORACLES["q32_unify_job_report"] = (
    "SELECT total_records, unique_incidents, total_input, missing_required_fields, invalid_dates, invalid_geometry, passed,"
    " duplicates_removed, years_filled, single_perimeter_incidents, multi_perimeter_incidents, max_perimeters, formal_ids FROM ("
    + ORACLES["q14_overall_report"].replace(_A, _FILED) + ")"
)
ORACLES["q33_training_pairs_job"] = _with(CTES, LINKS, BOXES) + (
    f"SELECT incident_id, curr_row, next_row, {_MEET} AS overlaps, true AS both_shapes FROM b WHERE epoch(next_ts) - epoch(curr_ts) < 604800"
)
ORACLES["q34_incident_lookup_job"] = f"SELECT * FROM ({ORACLES['q25_timeline']}) WHERE incident_id = '{LOOKED_UP}'"
ORACLES["q40_incident_lookups"] = _A + (
    "SELECT row_id, incident_id, CAST(perimeter_date AS VARCHAR) AS perimeter_date, source_dataset FROM u"
    f" WHERE incident_id IN ({', '.join(repr(i) for i in SOME_IDS)})"
)
ORACLES["q36_mixed_systems"] = _A + (
    "SELECT row_id, incident_id, CASE WHEN geom_kind = 'box' THEN CAST(round((cx - half) * 1024) AS BIGINT) END AS xmin,"
    " CASE WHEN geom_kind = 'box' THEN CAST(round((cy + half) * 1024) AS BIGINT) END AS ymax, 4326 AS srid FROM q WHERE reject_reason IS NULL"
)
ORACLES["q37_ordered_output"] = _A + (
    "SELECT row_id, priority, row_number() OVER (ORDER BY priority, row_id) - 1 AS place FROM (SELECT row_id,"
    " CASE source_dataset WHEN 'Interagency Fire Perimeter History' THEN 1 WHEN 'Historic GeoMAC (2000-2018)' THEN 2"
    " WHEN 'WFIGS Recent (2016-2025)' THEN 3 WHEN 'WFIGS Year to Date' THEN 4 WHEN 'WFIGS Current' THEN 5 ELSE 99 END AS priority FROM u)"
)
