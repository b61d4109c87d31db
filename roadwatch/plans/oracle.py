"""DuckDB SQL for each registered query (the correctness oracle).

Written independently of the Spark code: plain window functions, joins and
the literal range predicates of the reference (e.g. the inclusive
``BETWEEN day AND day + 24h`` existence test), so the set-based Spark
rewrites are checked against the direct formulation.
"""

from __future__ import annotations

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_LIMIT = "CASE WHEN s_suppkey % 7 = 0 THEN 0 ELSE 20 + 10 * (s_nationkey % 8) END"

BASE = f"""
WITH passages AS (
  SELECT (epoch_us(ts) // 1000) AS action_time,
         lpad(CAST({_K} AS VARCHAR), 4, '0') AS monitor_id,
         lpad(CAST(event_id % 100000 AS VARCHAR), 5, '0') AS camera_id,
         'C' || CAST(user_id AS VARCHAR) AS car,
         value AS speed,
         CAST({_K} % 20 AS VARCHAR) AS road_id,
         CAST({_K} % 10 AS VARCHAR) AS area_id,
         event_id
  FROM events),
monitors AS (
  SELECT lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS monitor_id,
         CAST(s_suppkey % 20 AS VARCHAR) AS road_id,
         CAST({_LIMIT} AS INTEGER) AS speed_limit,
         CAST(s_suppkey % 10 AS VARCHAR) AS area_id
  FROM supplier WHERE {_LIMIT} > 0),
stations AS (
  SELECT monitor_id, speed_limit AS limit_speed FROM (
    SELECT *, row_number() OVER (PARTITION BY monitor_id ORDER BY speed_limit, road_id, area_id) AS rn
    FROM monitors) WHERE rn = 1),
violations AS (
  SELECT 'C' || CAST(user_id AS VARCHAR) AS car, 'error' AS msg, (epoch_us(ts) // 1000) AS create_time, event_id
  FROM events WHERE event_type = 'error'),
actions AS (
  SELECT CAST({_K} AS VARCHAR) AS police_id, 'C' || CAST(user_id AS VARCHAR) AS car,
         'done' AS action_status, (epoch_us(ts) // 1000) AS action_time, event_id
  FROM events WHERE event_type = 'click')"""

DAY = 86_400_000

_AVG = f"""
, win AS (
  SELECT p.*, (p.action_time - p.action_time % 21600000) - r.j * 21600000 AS start_time
  FROM passages p, (SELECT range AS j FROM range(0, 4)) r),
avg_speed AS (
  SELECT start_time, start_time + {DAY} AS end_time, monitor_id,
         CAST((2 * CAST(sum(CAST(speed AS DECIMAL(18,4))) * 10000 AS BIGINT) + 100 * count(*))
              // (200 * count(*)) AS DOUBLE) / CAST(100 AS DOUBLE) AS avg_speed,
         CAST(count(*) AS INTEGER) AS car_count
  FROM win WHERE action_time >= start_time AND action_time < start_time + {DAY}
  GROUP BY start_time, monitor_id)"""

_SPEEDING = "p.car, p.monitor_id, p.road_id, p.speed AS real_speed"

SQL: dict[str, str] = {
    "parse_passages": BASE + """
SELECT action_time, monitor_id, camera_id, car, speed, road_id, area_id FROM passages""",

    "parse_passages_permissive": BASE + """
SELECT p.action_time, p.monitor_id, p.camera_id, p.car, p.speed, p.road_id, p.area_id
FROM passages p JOIN events e ON p.event_id = e.event_id WHERE e.event_type <> 'signup'""",

    "parse_rejects": BASE + """
SELECT concat_ws(',', CAST(p.action_time AS VARCHAR), p.monitor_id, p.camera_id, p.car, p.road_id) AS line,
       'expected 7 fields, got 5' AS reason
FROM passages p JOIN events e ON p.event_id = e.event_id WHERE e.event_type = 'signup'""",

    "overspeed": BASE + f"""
SELECT {_SPEEDING}, s.limit_speed, p.action_time, p.event_id
FROM passages p JOIN stations s ON p.monitor_id = s.monitor_id
WHERE s.limit_speed < CAST(1.1 AS DOUBLE) * p.speed""",

    "limits_with_default": BASE + f"""
SELECT {_SPEEDING}, CAST(coalesce(s.limit_speed, 60) AS INTEGER) AS limit_speed, p.action_time, p.event_id
FROM passages p LEFT JOIN stations s ON p.monitor_id = s.monitor_id""",

    "avg_speed": BASE + _AVG + """
SELECT * FROM avg_speed""",

    "top_n_monitors": BASE + _AVG + """
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY end_time ORDER BY car_count DESC, monitor_id) AS BIGINT) AS rank
  FROM avg_speed) WHERE rank <= 3""",

    "area_distinct": BASE + f"""
SELECT action_time - action_time % {DAY} AS start_time, action_time - action_time % {DAY} + {DAY} AS end_time,
       area_id, count(DISTINCT car) AS car_count
FROM passages GROUP BY ALL""",

    "area_distinct_running": BASE + f"""
, d AS (SELECT *, action_time - action_time % {DAY} AS start_time FROM passages),
f AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY area_id, start_time, car
                                            ORDER BY action_time, event_id) = 1 THEN 1 ELSE 0 END AS is_first
      FROM d)
SELECT area_id, start_time, start_time + {DAY} AS end_time, car, action_time, event_id,
       CAST(sum(is_first) OVER (PARTITION BY area_id, start_time ORDER BY action_time, event_id
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS distinct_cars
FROM f""",

    "clone_plates": BASE + """
, l AS (
  SELECT car, monitor_id, action_time, event_id,
         lag(action_time) OVER w AS pt, lag(monitor_id) OVER w AS pm, row_number() OVER w AS seq
  FROM passages WINDOW w AS (PARTITION BY car ORDER BY action_time, event_id)),
k AS (SELECT *, CASE WHEN pt IS NOT NULL AND abs(action_time - pt) // 1000 <= 3600 THEN 0 ELSE 1 END AS brk FROM l),
i AS (SELECT *, max(CASE WHEN brk = 1 THEN seq END) OVER (PARTITION BY car ORDER BY action_time, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS istart FROM k)
SELECT car,
       CASE WHEN action_time > pt THEN pm ELSE monitor_id END AS first_monitor,
       monitor_id AS second_monitor,
       '涉嫌套牌车' AS msg, action_time
FROM i WHERE (seq - istart) % 2 = 1""",

    "dangerous_driving": BASE + """
, lim AS (
  SELECT p.car, p.action_time, p.event_id, p.monitor_id, p.speed, coalesce(s.limit_speed, 60) AS limit_speed
  FROM passages p LEFT JOIN stations s ON p.monitor_id = s.monitor_id),
h AS (
  SELECT car, action_time, event_id, monitor_id,
         row_number() OVER (PARTITION BY car ORDER BY action_time, event_id) AS rn
  FROM lim WHERE limit_speed * CAST(1.2 AS DOUBLE) <= speed),
m AS (
  SELECT a.car, a.action_time AS start_time, b.action_time AS end_time, a.rn AS rs, b.rn AS re
  FROM h a JOIN h b ON a.car = b.car AND b.rn >= a.rn + 2 AND b.action_time - a.action_time < 86400000)
SELECT m.car, m.start_time, m.end_time, CAST(m.re - m.rs + 1 AS BIGINT) AS n_events,
       string_agg(h.monitor_id, ',' ORDER BY h.rn) AS monitor_ids, CAST(0.0 AS DOUBLE) AS avg_speed
FROM m JOIN h ON h.car = m.car AND h.rn BETWEEN m.rs AND m.re
GROUP BY m.car, m.start_time, m.end_time, m.rs, m.re""",

    "dangerous_driving_first": BASE + """
, lim AS (
  SELECT p.car, p.action_time, p.event_id, p.monitor_id, p.speed, coalesce(s.limit_speed, 60) AS limit_speed
  FROM passages p LEFT JOIN stations s ON p.monitor_id = s.monitor_id),
h AS (
  SELECT car, action_time, event_id, monitor_id,
         row_number() OVER (PARTITION BY car ORDER BY action_time, event_id) AS rn
  FROM lim WHERE limit_speed * CAST(1.2 AS DOUBLE) <= speed),
m AS (
  SELECT a.car, a.action_time AS start_time, b.action_time AS end_time, a.rn AS rs, b.rn AS re
  FROM h a JOIN h b ON a.car = b.car AND b.rn = a.rn + 2 AND b.action_time - a.action_time < 86400000)
SELECT m.car, m.start_time, m.end_time, CAST(m.re - m.rs + 1 AS BIGINT) AS n_events,
       string_agg(h.monitor_id, ',' ORDER BY h.rn) AS monitor_ids, CAST(0.0 AS DOUBLE) AS avg_speed
FROM m JOIN h ON h.car = m.car AND h.rn BETWEEN m.rs AND m.re
GROUP BY m.car, m.start_time, m.end_time, m.rs, m.re""",

    "interval_join": BASE + """
SELECT v.car, v.msg, v.create_time, v.event_id AS violation_id,
       a.police_id, a.action_status, a.action_time, a.event_id AS action_id
FROM violations v JOIN actions a ON v.car = a.car
 AND a.action_time BETWEEN v.create_time - 7200000 AND v.create_time + 7200000""",

    "interval_join_outer": BASE + """
SELECT coalesce(v.car, a.car) AS car, v.msg, v.create_time, v.event_id AS violation_id,
       a.police_id, a.action_status, a.action_time, a.event_id AS action_id
FROM violations v FULL OUTER JOIN actions a ON v.car = a.car
 AND a.action_time BETWEEN v.create_time - 7200000 AND v.create_time + 7200000""",

    "pair_actions": BASE + """
, u AS (
  SELECT car, 0 AS kind, create_time AS t, event_id AS id, event_id AS violation_id, create_time, msg,
         CAST(NULL AS BIGINT) AS action_id, CAST(NULL AS VARCHAR) AS police_id,
         CAST(NULL AS VARCHAR) AS action_status, CAST(NULL AS BIGINT) AS action_time
  FROM violations
  UNION ALL
  SELECT car, 1, action_time, event_id, NULL, NULL, NULL, event_id, police_id, action_status, action_time
  FROM actions),
l AS (
  SELECT *, row_number() OVER w AS seq, lag(kind) OVER w AS pk, lag(t) OVER w AS pt,
         lag(violation_id) OVER w AS p_violation_id, lag(create_time) OVER w AS p_create_time,
         lag(msg) OVER w AS p_msg, lag(action_id) OVER w AS p_action_id, lag(police_id) OVER w AS p_police_id,
         lag(action_status) OVER w AS p_action_status, lag(action_time) OVER w AS p_action_time
  FROM u WINDOW w AS (PARTITION BY car ORDER BY t, kind, id)),
k AS (SELECT *, (pk IS NOT NULL AND pk <> kind AND t - pt <= 43200000) AS link FROM l),
i AS (
  SELECT *, max(CASE WHEN NOT link THEN seq END) OVER (PARTITION BY car ORDER BY t, kind, id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS istart,
         lead(link) OVER (PARTITION BY car ORDER BY t, kind, id) AS nlink
  FROM k),
o AS (SELECT *, (seq - istart) % 2 = 1 AS second FROM i)
SELECT car,
       CASE WHEN second THEN 'matched' WHEN kind = 0 THEN 'no_police' ELSE 'no_violation' END AS outcome,
       CASE WHEN second THEN coalesce(violation_id, p_violation_id) ELSE violation_id END AS violation_id,
       CASE WHEN second THEN coalesce(create_time, p_create_time) ELSE create_time END AS create_time,
       CASE WHEN second THEN coalesce(msg, p_msg) ELSE msg END AS msg,
       CASE WHEN second THEN coalesce(action_id, p_action_id) ELSE action_id END AS action_id,
       CASE WHEN second THEN coalesce(police_id, p_police_id) ELSE police_id END AS police_id,
       CASE WHEN second THEN coalesce(action_status, p_action_status) ELSE action_status END AS action_status,
       CASE WHEN second THEN coalesce(action_time, p_action_time) ELSE action_time END AS action_time
FROM o WHERE second OR NOT coalesce(nlink, false)""",

    "violations_per_day": BASE + f"""
, n AS (
  SELECT car, msg, create_time, create_time - create_time % {DAY} AS day,
         row_number() OVER (PARTITION BY car, create_time - create_time % {DAY}
                            ORDER BY create_time, event_id) AS rn
  FROM violations),
existing AS (
  SELECT 'C' || CAST(user_id AS VARCHAR) AS car, (epoch_us(ts) // 1000) AS create_time
  FROM events WHERE event_type = 'signup')
SELECT car, msg, create_time FROM n
WHERE rn = 1 AND NOT EXISTS (
  SELECT 1 FROM existing e WHERE e.car = n.car AND e.create_time BETWEEN n.day AND n.day + {DAY})""",

    "tracks": BASE + """
, l AS (
  SELECT car, monitor_id, action_time, event_id,
         lag(action_time) OVER w AS pt, row_number() OVER w AS seq
  FROM passages WINDOW w AS (PARTITION BY car ORDER BY action_time, event_id)),
k AS (SELECT *, CASE WHEN pt IS NOT NULL AND abs(action_time - pt) // 1000 <= 300 THEN 0 ELSE 1 END AS brk FROM l),
i AS (SELECT *, max(CASE WHEN brk = 1 THEN seq END) OVER (PARTITION BY car ORDER BY action_time, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS istart FROM k),
listed AS (SELECT DISTINCT car FROM i WHERE (seq - istart) % 2 = 1),
t AS (
  SELECT p.car || '_' || CAST(9223372036854775807 - p.action_time AS VARCHAR) AS row_key, p.*
  FROM passages p WHERE p.car IN (SELECT car FROM listed)),
r AS (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY event_id DESC) AS rn FROM t)
SELECT row_key, car, action_time, monitor_id, road_id, area_id, speed FROM r WHERE rn = 1""",

    "count_batches": BASE + """
, r AS (SELECT *, row_number() OVER (ORDER BY action_time, event_id) - 1 AS row_index,
               count(*) OVER () AS total FROM passages)
SELECT action_time, monitor_id, camera_id, car, speed, road_id, area_id, event_id,
       row_index, row_index // 7 AS batch_id
FROM r WHERE row_index < (total // 7) * 7""",
}


# ---- pair_actions_replay: the timer state machine as a recursive walk over each
# car's records (slot = the pending record, timers = pending deadlines; a timer
# below the next record's time fires first and reports the pending record).
_TIMEOUT = 43200000
_FIELDS = ("violation_id BIGINT, create_time BIGINT, msg VARCHAR, action_id BIGINT, "
           "police_id VARCHAR, action_status VARCHAR, action_time BIGINT")
_SLOT_T = f"STRUCT(kind INTEGER, t BIGINT, {_FIELDS})"
_OUT_T = f"STRUCT(outcome VARCHAR, {_FIELDS})"
_FIRED = "(len(list_filter(s.timers, lambda x: x < e.t)) > 0)"
_SLOT1 = f"(CASE WHEN {_FIRED} THEN NULL ELSE s.slot END)"
_MATCH = f"({_SLOT1}.kind IS NOT NULL AND {_SLOT1}.kind <> e.kind)"
_E_SLOT = ("{'kind': e.kind, 't': e.t, 'violation_id': e.violation_id, 'create_time': e.create_time, "
           "'msg': e.msg, 'action_id': e.action_id, 'police_id': e.police_id, "
           "'action_status': e.action_status, 'action_time': e.action_time}")


def _alone(slot):
    return (f"{{'outcome': CASE WHEN {slot}.kind = 0 THEN 'no_police' ELSE 'no_violation' END, "
            f"'violation_id': {slot}.violation_id, 'create_time': {slot}.create_time, 'msg': {slot}.msg, "
            f"'action_id': {slot}.action_id, 'police_id': {slot}.police_id, "
            f"'action_status': {slot}.action_status, 'action_time': {slot}.action_time}}")

_MATCHED = ("{'outcome': 'matched', " + ", ".join(
    f"'{c}': coalesce(e.{c}, {_SLOT1}.{c})" for c in
    ["violation_id", "create_time", "msg", "action_id", "police_id", "action_status", "action_time"]) + "}")

_REPLAY_SQL = BASE.replace("WITH passages AS (", "WITH RECURSIVE passages AS (", 1) + f"""
, u AS (
  SELECT car, 0 AS kind, create_time AS t, event_id AS id, event_id AS violation_id, create_time, msg,
         CAST(NULL AS BIGINT) AS action_id, CAST(NULL AS VARCHAR) AS police_id,
         CAST(NULL AS VARCHAR) AS action_status, CAST(NULL AS BIGINT) AS action_time
  FROM violations
  UNION ALL
  SELECT car, 1, action_time, event_id, NULL, NULL, NULL, event_id, police_id, action_status, action_time
  FROM actions),
e AS (SELECT *, row_number() OVER (PARTITION BY car ORDER BY t, kind, id) AS rn FROM u),
s AS (
  SELECT car, CAST(0 AS BIGINT) AS rn, CAST(NULL AS {_SLOT_T}) AS slot, CAST([] AS BIGINT[]) AS timers,
         CAST([] AS {_OUT_T}[]) AS outs
  FROM (SELECT DISTINCT car FROM e)
  UNION ALL
  SELECT s.car, e.rn,
         CASE WHEN {_MATCH} THEN NULL ELSE {_E_SLOT} END,
         CASE WHEN {_MATCH} THEN list_filter(s.timers, lambda x: x >= e.t)
              ELSE list_append(list_filter(s.timers, lambda x: x >= e.t), e.t + {_TIMEOUT}) END,
         list_concat(CASE WHEN {_FIRED} AND s.slot IS NOT NULL THEN [{_alone('s.slot')}] ELSE [] END,
                     CASE WHEN {_MATCH} THEN [{_MATCHED}] ELSE [] END)
  FROM s JOIN e ON e.car = s.car AND e.rn = s.rn + 1),
last AS (SELECT car, max(rn) AS rn FROM s GROUP BY car),
o AS (
  SELECT s.car, unnest(s.outs) AS r FROM s
  UNION ALL
  SELECT s.car, {_alone('s.slot')} FROM s JOIN last ON s.car = last.car AND s.rn = last.rn
  WHERE s.slot IS NOT NULL)
SELECT car, r.outcome AS outcome, r.violation_id AS violation_id, r.create_time AS create_time, r.msg AS msg,
       r.action_id AS action_id, r.police_id AS police_id, r.action_status AS action_status,
       r.action_time AS action_time
FROM o"""


SQL["pair_actions_replay"] = _REPLAY_SQL

SQL["parse_violations"] = BASE + """
SELECT car, msg, create_time FROM violations"""

SQL["parse_police_actions"] = BASE + """
SELECT police_id, car, action_status, action_time FROM actions"""

SQL["station_table"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS monitor_id, s_name AS road_id, CAST(s_nationkey AS INTEGER) AS speed_limit
FROM supplier WHERE s_nationkey > 0"""

SQL["violation_table"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS car, CAST(l_partkey AS VARCHAR) AS msg, CAST(l_suppkey AS BIGINT) AS create_time
FROM lineitem"""

SQL["tracks_reduced"] = SQL["tracks"]
SQL["newest_tracks"] = f"""
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY car ORDER BY row_key) AS BIGINT) AS rank
               FROM ({SQL['tracks']})) WHERE rank <= 5"""

SQL["outcome_tables"] = f"""
SELECT *, outcome AS side FROM ({SQL['pair_actions']})"""

SQL["area_counters"] = f"""
SELECT CAST(end_time AS VARCHAR) || '_' || area_id AS count_key, max(distinct_cars) AS distinct_cars
FROM ({SQL['area_distinct_running']}) GROUP BY ALL"""

_BIT = "CAST(('0x' || substr(md5(car), {at}, 15))::BIGINT % 4096 AS BIGINT)"
SQL["area_distinct_running_bloom"] = BASE + f"""
, d AS (SELECT *, action_time - action_time % {DAY} AS start_time, {_BIT.format(at=1)} AS b1, {_BIT.format(at=17)} AS b2
        FROM passages),
t AS (SELECT area_id, start_time, action_time, event_id, b1 AS bit, 0 AS i FROM d
      UNION ALL SELECT area_id, start_time, action_time, event_id, b2, 1 FROM d),
f AS (SELECT *, row_number() OVER (PARTITION BY area_id, start_time, bit ORDER BY action_time, event_id, i) = 1 AS setter FROM t),
n AS (SELECT area_id, start_time, event_id, CASE WHEN bool_or(setter) THEN 1 ELSE 0 END AS w FROM f GROUP BY ALL)
SELECT d.area_id, d.start_time, d.start_time + {DAY} AS end_time, d.car, d.action_time, d.event_id,
       CAST(sum(n.w) OVER (PARTITION BY d.area_id, d.start_time ORDER BY d.action_time, d.event_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS distinct_cars
FROM d JOIN n ON d.event_id = n.event_id AND d.area_id = n.area_id AND d.start_time = n.start_time"""

SQL["area_messages"] = f"""
SELECT *, '区域' || area_id || ',在窗口其实时间' || start_time || ',到窗口结束时间' || end_time
          || ' ,一共有' || car_count || ' 辆车' AS message
FROM ({SQL['area_distinct']})"""

SQL["top_n_messages"] = f"""
SELECT end_time, '在窗口' || min(start_time) || ' ----' || end_time || ' 时间范围内:' || '整个城市最拥堵的前3个卡口是:'
       || string_agg('卡口:' || monitor_id || ',经过的车辆数量为:' || car_count || ',平均车速为:' || CAST(avg_speed AS VARCHAR), '' ORDER BY rank)
       || chr(10) AS message
FROM ({SQL['top_n_monitors']}) GROUP BY end_time"""

SQL["limits_as_of"] = BASE + f"""
, h AS (
  SELECT lpad(CAST({_K} AS VARCHAR), 4, '0') AS monitor_id, epoch_us(ts) // 1000 AS valid_from,
         min(CASE WHEN event_id % 7 = 0 THEN 0 ELSE 20 + 10 * (event_id % 8) END) FILTER (event_id % 7 <> 0) AS speed_limit
  FROM events WHERE event_type = 'signup' GROUP BY ALL HAVING speed_limit > 0)
SELECT {_SPEEDING}, CAST(coalesce(h.speed_limit, 60) AS INTEGER) AS limit_speed, p.action_time, p.event_id
FROM passages p ASOF LEFT JOIN h ON p.monitor_id = h.monitor_id AND p.action_time >= h.valid_from"""

SQL["area_distinct_panes"] = BASE + f"""
, win AS (
  SELECT p.area_id, p.car, (p.action_time - p.action_time % 21600000) - r.j * 21600000 AS start_time
  FROM passages p, (SELECT range AS j FROM range(0, 4)) r)
SELECT start_time, start_time + {DAY} AS end_time, area_id, count(DISTINCT car) AS car_count, TRUE AS within_3_rsd
FROM win GROUP BY ALL"""
