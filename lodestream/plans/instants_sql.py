"""DuckDB SQL for times in many notations, independent of the expressions it checks."""

from __future__ import annotations

_FORMATS = ["%Y-%m-%dT%H:%M:%S.%g", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S.%g", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%Y%m%dT%H%M%S", "%d %b %Y %H:%M:%S", "%d %b %Y", "%d %B %Y", "%d-%b-%Y %H:%M:%S", "%B %d, %Y %I:%M %p"]
_SLASHED = ["%d/%m/%Y %I:%M %p", "%d/%m/%Y %H:%M:%S", "%d/%m/%Y"]
_NAMES = {"IST": 330, "EST": -300, "EDT": -240, "GMT": 0, "BST": 60, "CET": 60, "CEST": 120, "SGT": 480}


def utc_ms_sql(text: str, zone: str) -> str:
    """An expression for the instant that ``text`` states, in UTC milliseconds, or null."""
    listed = lambda fs: "[" + ", ".join(f"'{f}'" for f in fs) + "]"
    x = f"trim({text})"
    bare = rf"regexp_replace({x}, '\[[^\]]*\]$', '')"
    mark = rf"regexp_extract({bare}, '(?::[0-9]{{2}}|T[0-9]{{6}}|\.[0-9]+) ?(Z|[+-][0-9]{{2}}:?[0-9]{{2}}|{'|'.join(_NAMES)})$', 1)"
    clock = rf"regexp_replace({bare}, '(:[0-9]{{2}}|T[0-9]{{6}}|\.[0-9]+) ?(Z|[+-][0-9]{{2}}:?[0-9]{{2}}|{'|'.join(_NAMES)})$', '\1')"
    clock = rf"regexp_replace(regexp_replace(regexp_replace({clock}, '^[A-Za-z]{{3}}, ', ''), '^([0-9]{{1,2}})(st|nd|rd|th) ', '\1 '), '(\.[0-9]{{3}})[0-9]*$', '\1')"
    local = f"coalesce(try_strptime({clock}, {listed(_FORMATS)}), CASE WHEN {zone} = 'America/New_York' THEN try_strptime({clock}, {listed([f.replace('%d/%m', '%m/%d') for f in _SLASHED])}) ELSE try_strptime({clock}, {listed(_SLASHED)}) END)"
    names = " ".join(f"WHEN '{k}' THEN {v}" for k, v in _NAMES.items())
    offset = rf"CASE WHEN {mark} = 'Z' THEN 0 WHEN regexp_matches({mark}, '^[+-]') THEN (CASE WHEN {mark}[1] = '-' THEN -1 ELSE 1 END) * ({mark}[2:3]::INT * 60 + right({mark}, 2)::INT) ELSE CASE {mark} {names} END END"
    return (
        f"CASE WHEN regexp_matches({x}, '^[0-9]{{9,11}}$') THEN {x}::BIGINT * 1000 WHEN regexp_matches({x}, '^[0-9]{{12,14}}$') THEN {x}::BIGINT "
        rf"WHEN regexp_matches({x}, '^[0-9]{{4,6}}(\.[0-9]+)?$') THEN epoch_ms(timezone({zone}, TIMESTAMP '1899-12-30' + to_milliseconds(round({x}::DOUBLE * 86400000)::BIGINT))) "
        f"WHEN {mark} <> '' THEN epoch_ms({local}) - ({offset}) * 60000 ELSE epoch_ms(timezone({zone}, {local})) END"
    )


P6_SQL = "SELECT DISTINCT * FROM (" + " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, {key} AS record_key, '{field}' AS field_name, {utc_ms_sql(field, zone)} AS utc_ms FROM {table}"
    for table, key, field, zone in (("outlook_messages", "graph_id", "received_date_time", "mailbox_zone"), ("final_corrected_requirements", "job_id", "demand_received_date", "'Asia/Kolkata'"), ("metaforge_requirements", "job_id", "created_at", "'Asia/Kolkata'"))
) + ") WHERE utc_ms IS NOT NULL AND record_key IS NOT NULL"

_FIELDS = ("job_status", "number_of_positions", "location", "work_mode", "notice_period", "yearly_budget")
_ZONE = "'Asia/Kolkata'"
_LIST = "CASE WHEN json_valid(field_change_history) THEN CASE WHEN json_type(field_change_history) = 'VARCHAR' THEN (field_change_history::JSON->>'$') ELSE field_change_history END END"
P4_SQL = f"""WITH h AS (SELECT job_id, unnest(from_json(CASE WHEN json_valid(l) AND l <> '' THEN l ELSE '[]' END, '["JSON"]')) AS e FROM (SELECT job_id, {_LIST} AS l FROM metaforge_requirements)),
    hc AS (SELECT job_id, e->>'$.changed_at' AS said, e->'$.changes' AS c FROM h), vc AS (SELECT requirement_id AS job_id, created_at AS said, changes_json::JSON AS c FROM jd_versions WHERE version_number > 1 AND json_valid(changes_json)),
    ch AS (SELECT job_id, {utc_ms_sql('said', _ZONE)} AS ms, f.field, c->>('$.' || f.field || '.old') AS old, c->>('$.' || f.field || '.new') AS new, json_exists(c, '$.' || f.field) AS has FROM (SELECT * FROM hc UNION ALL SELECT * FROM vc), (VALUES {', '.join(f"('{f}')" for f in _FIELDS)}) AS f(field)),
    cg AS (SELECT job_id, ms, field, old, new FROM ch WHERE has AND ms IS NOT NULL),
    one AS (SELECT requirement_id AS job_id, arg_min(payload_json, id) AS p, min({utc_ms_sql('created_at', _ZONE)}) AS one_ms FROM jd_versions WHERE version_number = 1 GROUP BY 1),
    st AS (SELECT job_id, {utc_ms_sql('created_at', _ZONE)} AS created_ms FROM metaforge_requirements),
    b AS (SELECT coalesce(st.job_id, one.job_id) AS job_id, coalesce(created_ms, one_ms) AS ms, p FROM st FULL OUTER JOIN one ON one.job_id = st.job_id),
    fo AS (SELECT job_id, field, arg_min(old, (ms, old)) AS old FROM cg GROUP BY 1, 2),
    bg AS (SELECT b.job_id, b.ms, f.field, CASE WHEN json_valid(p) THEN p->>('$.' || f.field) ELSE fo.old END AS v FROM b CROSS JOIN (VALUES {', '.join(f"('{f}')" for f in _FIELDS)}) AS f(field) LEFT JOIN fo ON fo.job_id = b.job_id AND fo.field = f.field),
    al AS (SELECT job_id, field, ms, lower(trim(regexp_replace(v, '\\s+', ' ', 'g'))) AS v FROM (SELECT job_id, field, ms, v FROM bg UNION ALL SELECT job_id, field, ms, new FROM cg) WHERE v IS NOT NULL AND ms IS NOT NULL),
    d AS (SELECT job_id, field, ms, max(v) AS v FROM al WHERE v NOT IN (SELECT placeholder FROM placeholder_values) GROUP BY 1, 2, 3),
    r AS (SELECT *, lag(v) OVER w AS pv FROM d WINDOW w AS (PARTITION BY job_id, field ORDER BY ms)), s AS (SELECT job_id, field, v, ms, lead(ms) OVER w AS nx, count(*) OVER (PARTITION BY job_id, field) AS n FROM r WHERE pv IS DISTINCT FROM v WINDOW w AS (PARTITION BY job_id, field ORDER BY ms))
    SELECT job_id, field AS field_name, v AS field_value, ms AS valid_from_ms, coalesce(nx, 0) AS valid_to_ms FROM s WHERE n > 1"""
