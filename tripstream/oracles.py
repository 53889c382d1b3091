"""DuckDB SQL for each query of the catalog, over the same tables."""

import functools

from tripstream.catalog import BOUND_DAYS, BOX
from tripstream.replay import SLICES

_HOURLY = """
SELECT time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
       user_id AS driver_id,
       round(sum(value::DECIMAL(28, 10)), 4)::DOUBLE AS total_tips
FROM {events} GROUP BY 1, 2
"""

_MAX = """
SELECT window_end, driver_id, total_tips
FROM (SELECT *, row_number() OVER (PARTITION BY window_end
                                   ORDER BY total_tips DESC, driver_id) AS rank
      FROM ({hourly}))
WHERE rank = 1
"""

_HOURLY_OF_ALL = _HOURLY.format(events="events")
_HOURLY_MAX = _MAX.format(hourly=_HOURLY_OF_ALL)

# Every seventh fare lands a slice late, and is dropped if the watermark, a minute behind all that landed in earlier
# slices, has reached the end of its hour by then.
_LATE_LANDED = f"""WITH timed AS (SELECT *, epoch_us(ts) AS us FROM events), landed AS (
    SELECT timed.*, least(floor((us - lo) * {SLICES} / (hi - lo + 1))::INT + (event_id % 7 = 0)::INT, {SLICES} - 1) AS slice
    FROM timed, (SELECT min(us) AS lo, max(us) AS hi FROM timed)
  ), newest AS (
    SELECT k AS slice, max(us) // 1000 - 60000 AS watermark FROM landed, range({SLICES} + 1) t(k) WHERE slice < k GROUP BY k
  )"""
_IN_TIME = "n.watermark IS NULL OR (epoch_us(time_bucket(INTERVAL '1 hour', l.ts)) + 3600000000) // 1000 > n.watermark"
_HOURLY_MAX_LATE = _MAX.format(hourly=_HOURLY.format(events=f"""(
  {_LATE_LANDED}
  SELECT l.* FROM landed l LEFT JOIN newest n USING (slice)
  WHERE {_IN_TIME})"""))

_PLACED = """
SELECT event_id AS ride_id, event_type = 'view' AS is_start, ts AS event_time,
       (event_id * 7 % 401)::DOUBLE / 100 - 2 AS start_lon,
       (event_id * 11 % 397)::DOUBLE / 100 - 2 AS start_lat,
       (event_id * 13 % 389)::DOUBLE / 100 - 2 AS end_lon,
       (event_id * 17 % 383)::DOUBLE / 100 - 2 AS end_lat
FROM events
"""

_CLEANSED = f"""
SELECT * FROM ({_PLACED})
WHERE start_lon BETWEEN {BOX.west} AND {BOX.east} AND start_lat BETWEEN {BOX.south} AND {BOX.north}
  AND end_lon BETWEEN {BOX.west} AND {BOX.east} AND end_lat BETWEEN {BOX.south} AND {BOX.north}
"""

# The pairing rules replayed event by event: one step of the recursion is each user's next event.
_REPLAYED = """
WITH RECURSIVE item AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type DESC) AS n,
         count(*) OVER (PARTITION BY user_id) AS total
  FROM events WHERE event_type IN ('view', 'purchase')
), step AS (
  SELECT user_id, n, total, event_type AS kind, event_id AS held, NULL::BIGINT AS ride,
         NULL::BIGINT AS fare
  FROM item WHERE n = 1
  UNION ALL
  SELECT i.user_id, i.n, i.total,
         CASE WHEN s.kind <> i.event_type THEN NULL ELSE i.event_type END,
         CASE WHEN s.kind <> i.event_type THEN NULL ELSE i.event_id END,
         CASE WHEN s.kind <> i.event_type
              THEN CASE WHEN s.kind = 'view' THEN s.held ELSE i.event_id END END,
         CASE WHEN s.kind <> i.event_type
              THEN CASE WHEN s.kind = 'view' THEN i.event_id ELSE s.held END END
  FROM step s JOIN item i ON i.user_id = s.user_id AND i.n = s.n + 1
)
"""

_PAIRS = _REPLAYED + """
SELECT s.user_id AS ride_id, r.ts AS ride_event_time, s.ride AS ride_event_id,
       f.ts AS fare_event_time, s.fare AS fare_event_id, f.value AS fare_tip
FROM step s JOIN events r ON r.event_id = s.ride JOIN events f ON f.event_id = s.fare
"""

_WAITING = _REPLAYED + """
SELECT s.user_id AS ride_id,
       CASE WHEN s.kind = 'view' THEN e.ts END AS ride_event_time,
       CASE WHEN s.kind = 'view' THEN s.held END AS ride_event_id,
       CASE WHEN s.kind = 'purchase' THEN e.ts END AS fare_event_time,
       CASE WHEN s.kind = 'purchase' THEN s.held END AS fare_event_id,
       CASE WHEN s.kind = 'purchase' THEN e.value END AS fare_tip
FROM step s JOIN events e ON e.event_id = s.held
WHERE s.n = s.total
"""

_UNIQUE = """
WITH ride AS (
  SELECT o_orderkey AS ride_id, o_orderdate AS event_time FROM orders WHERE o_orderkey % 1000 <> 0
), fare AS (
  SELECT l_orderkey AS ride_id, min(l_shipdate) AS event_time,
         round(sum(l_extendedprice), 2) AS tip
  FROM lineitem GROUP BY l_orderkey
)
"""

_FLAT = "r.event_time AS ride_event_time, f.event_time AS fare_event_time, f.tip AS fare_tip"

_NEAR = (
    f"r.ride_id = f.ride_id AND r.event_time BETWEEN f.event_time - INTERVAL {BOUND_DAYS} DAY "
    f"AND f.event_time + INTERVAL {BOUND_DAYS} DAY"
)

# The watermark trails the older of the two newest events by a minute. A fare is given up when it
# lies further behind than the bound.
_GIVEN_UP = f"""
f.event_time + INTERVAL {BOUND_DAYS} DAY
  < least((SELECT max(event_time) FROM ride), (SELECT max(event_time) FROM fare))
    - INTERVAL 60 SECOND
"""

_REGISTRIES = """
WITH a AS (SELECT c_nationkey AS nation, floor(c_acctbal / 1000)::BIGINT AS band FROM customer),
     b AS (SELECT s_nationkey AS nation, floor(s_acctbal / 1000)::BIGINT AS band FROM supplier)
"""

# The expiry rules replayed: slices of event time, in which every thirteenth record lands one late, each ended by a
# tick that carries the watermark known by then. `timers` holds the due times of a user, those of replaced records too.
# `replaced` is whether a record that gives way to another is put out.
_EXPIRED = """
WITH RECURSIVE chosen AS (
  SELECT user_id, event_type, event_id, value, ts, epoch_us(ts) AS us
  FROM events WHERE event_type IN ('view', 'purchase') AND {chosen}
), sliced AS (
  SELECT c.*, least(floor((us - lo) * {slices} / (hi - lo + 1))::INT + (event_id % 13 = 0)::INT, {slices} - 1) AS slice
  FROM chosen c, (SELECT min(us) AS lo, max(us) AS hi FROM chosen)
), newest AS (
  SELECT k AS slice,
         {moved_by}(max(us) FILTER (event_type = 'view'), max(us) FILTER (event_type = 'purchase'))
           // 1000 - 60000 AS watermark
  FROM sliced, range({slices}) t(k) WHERE slice <= k GROUP BY k
), entry AS (
  SELECT user_id, slice, event_type AS kind, event_id, us // 1000 AS due, us FROM sliced
  UNION ALL
  SELECT user_id, slice, 'tick', NULL, watermark, NULL
  FROM newest, (SELECT DISTINCT user_id FROM chosen)
), item AS (
  SELECT *, row_number() OVER (PARTITION BY user_id
                               ORDER BY slice, kind = 'tick', us, kind DESC) AS n
  FROM entry
), step AS (
  SELECT user_id, 0::BIGINT AS n, NULL::VARCHAR AS kind, NULL::BIGINT AS held,
         NULL::BIGINT AS held_due, []::BIGINT[] AS timers,
         NULL::VARCHAR AS outcome, NULL::BIGINT AS ride, NULL::BIGINT AS fare
  FROM (SELECT DISTINCT user_id FROM chosen)
  UNION ALL
  SELECT user_id, n,
         CASE act WHEN 'wait' THEN new_kind WHEN 'pass' THEN kind END,
         CASE act WHEN 'wait' THEN event_id WHEN 'pass' THEN held END,
         CASE act WHEN 'wait' THEN due WHEN 'pass' THEN held_due END,
         CASE WHEN act = 'wait' THEN list_append(timers, due)
              WHEN act = 'pair' THEN list_filter(timers, lambda t: t <> held_due)
              ELSE list_filter(timers, lambda t: t > due) END,
         CASE WHEN act = 'pair' THEN 'matched'
              WHEN act = 'expire' OR {replaced} AND act = 'wait'
              THEN CASE kind WHEN 'view' THEN 'unmatched_ride' WHEN 'purchase' THEN 'unmatched_fare' END END,
         CASE WHEN (act IN ('pair', 'expire') OR {replaced} AND act = 'wait') AND kind = 'view' THEN held
              WHEN act = 'pair' THEN event_id END,
         CASE WHEN (act IN ('pair', 'expire') OR {replaced} AND act = 'wait') AND kind = 'purchase' THEN held
              WHEN act = 'pair' THEN event_id END
  FROM (SELECT s.user_id, i.n, s.kind, s.held, s.held_due, s.timers, i.kind AS new_kind,
               i.event_id, i.due,
               CASE WHEN i.kind = 'tick' AND list_min(s.timers) <= i.due THEN 'expire'
                    WHEN i.kind = 'tick' THEN 'pass'
                    WHEN s.kind <> i.kind THEN 'pair'
                    ELSE 'wait' END AS act
        FROM step s JOIN item i ON i.user_id = s.user_id AND i.n = s.n + 1)
)
"""


def _expired(replaced: bool = False, moved_by: str = "least", chosen: str = "true") -> str:
    values = {"slices": SLICES, "replaced": str(replaced).lower(), "moved_by": moved_by, "chosen": chosen}
    return functools.reduce(lambda sql, name: sql.replace(f"{{{name}}}", str(values[name])), values, _EXPIRED)


_OUTCOMES = """
SELECT s.outcome, s.user_id AS ride_id, r.ts AS ride_event_time, s.ride AS ride_event_id,
       f.ts AS fare_event_time, s.fare AS fare_event_id, f.value AS fare_tip
FROM step s LEFT JOIN events r ON r.event_id = s.ride LEFT JOIN events f ON f.event_id = s.fare
WHERE s.outcome IS NOT NULL
"""

_STREAM_UNMATCHED = """
SELECT s.user_id AS ride_id, e.ts AS event_time, e.event_id{more}
FROM step s JOIN events e ON e.event_id = s.{kind}
WHERE s.outcome = 'unmatched_{kind}'
"""

_STATIONS = """
SELECT s_suppkey::INT AS id, s_name || ' (a/b, @c)' AS name,
       (s_suppkey % 1801)::DOUBLE / 20 - 45 AS lat,
       (s_suppkey % 3601)::DOUBLE / 20 - 90 AS long,
       (s_suppkey % 9 * 4 + 11)::INT AS dock_count,
       'City ' || s_nationkey AS city,
       DATE '2013-08-06' + (s_suppkey % 900)::INT AS installation_date
FROM supplier
"""

_OTHER_STATIONS = f"""
SELECT * REPLACE (CASE WHEN id % 4 = 0 THEN dock_count + 1 ELSE dock_count END AS dock_count)
FROM ({_STATIONS}) WHERE id % 2 = 0
"""


def oracle_sql() -> dict[str, str]:
    return {
        "hourly_tips_max": _HOURLY_MAX,
        "tips_per_driver_hour": _HOURLY_OF_ALL,
        "ride_cleansing": _CLEANSED,
        "ride_starts": f"SELECT * FROM ({_PLACED}) WHERE is_start",
        "ride_starts_sampled": """
            SELECT o_orderkey AS ride_id, o_orderstatus = 'O' AS is_start,
                   o_orderdate AS event_time
            FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 1000 <> 0""",
        "rides_fares_pairs": _PAIRS,
        "rides_fares_waiting": _WAITING,
        "rides_fares_join": f"{_UNIQUE} SELECT ride_id, {_FLAT} FROM ride r JOIN fare f USING (ride_id)",
        "enrichment_outcomes": f"""{_UNIQUE}
            SELECT CASE WHEN f.ride_id IS NULL THEN 'unmatched_ride'
                        WHEN r.ride_id IS NULL THEN 'unmatched_fare' ELSE 'matched' END AS outcome,
                   coalesce(r.ride_id, f.ride_id) AS ride_id, {_FLAT}
            FROM ride r FULL OUTER JOIN fare f ON r.ride_id = f.ride_id""",
        "unmatched_fares": f"""{_UNIQUE}
            SELECT * FROM fare f WHERE NOT EXISTS (FROM ride r WHERE r.ride_id = f.ride_id)""",
        "unmatched_rides": f"""{_UNIQUE}
            SELECT * FROM ride r WHERE NOT EXISTS (FROM fare f WHERE r.ride_id = f.ride_id)""",
        "unmatched_fares_within": f"""{_UNIQUE}
            SELECT * FROM fare f WHERE NOT EXISTS (FROM ride r WHERE {_NEAR})""",
        "unmatched_fares_filtered": f"""{_UNIQUE}
            SELECT * FROM fare f WHERE NOT EXISTS (
              FROM orders o WHERE o.o_orderkey = f.ride_id AND o_orderstatus = 'O' AND o_orderkey % 1000 <> 0)""",
        "rides_fares_join_bucketed": f"{_UNIQUE} SELECT ride_id, {_FLAT} FROM ride r JOIN fare f USING (ride_id)",
        "rides_fares_pairs_bucketed": _PAIRS,
        "ride_cleansing_by_place": _CLEANSED,
        "station_scan": _STATIONS,
        "station_intersect": f"{_STATIONS} INTERSECT {_OTHER_STATIONS}",
        "station_except": f"{_STATIONS} EXCEPT {_OTHER_STATIONS}",
        "registry_union_all": f"{_REGISTRIES} FROM a UNION ALL FROM b",
        "registry_union": f"{_REGISTRIES} FROM a UNION FROM b",
        "registry_intersect": f"{_REGISTRIES} FROM a INTERSECT FROM b",
        "registry_except": f"{_REGISTRIES} FROM a EXCEPT FROM b",
        "registry_except_all": f"{_REGISTRIES} FROM a EXCEPT ALL FROM b",
        "registry_except_all_stored": f"{_REGISTRIES} FROM a EXCEPT ALL FROM b",
        "registry_renumbered": """
            SELECT CASE WHEN min(o.p_partkey) <> n.id THEN min(o.p_partkey)
                        ELSE max(o.p_partkey) END AS old_id,
                   n.id AS new_id
            FROM part o JOIN (
              SELECT *, CASE WHEN p_partkey % 3 = 0 THEN p_partkey + 1000000000
                             ELSE p_partkey END AS id FROM part) n
              ON o.p_name IS NOT DISTINCT FROM n.p_name
             AND o.p_brand IS NOT DISTINCT FROM n.p_brand
             AND o.p_type IS NOT DISTINCT FROM n.p_type
             AND o.p_size IS NOT DISTINCT FROM n.p_size
             AND o.p_retailprice IS NOT DISTINCT FROM n.p_retailprice
            GROUP BY n.id HAVING min(o.p_partkey) <> n.id OR max(o.p_partkey) <> n.id""",
        "stream_ride_cleansing": _CLEANSED,
        "stream_hourly_tips": f"""
            SELECT * FROM ({_HOURLY_MAX})
            WHERE window_end <= (SELECT max(ts) - INTERVAL 60 SECOND FROM events)""",
        "stream_hourly_tips_late": f"""
            SELECT * FROM ({_HOURLY_MAX_LATE})
            WHERE window_end <= (SELECT max(ts) - INTERVAL 60 SECOND FROM events)""",
        "stream_hourly_tips_dropped": f"""{_LATE_LANDED}
            SELECT slice::BIGINT AS slice, count(*) AS fares, count(DISTINCT CASE WHEN NOT ({_IN_TIME})
                THEN (user_id, time_bucket(INTERVAL '1 hour', ts)) END) AS dropped_groups
            FROM landed l LEFT JOIN newest n USING (slice) GROUP BY slice""",
        "stream_rides_fares": _PAIRS,
        "stream_rides_fares_widened": f"""
            SELECT * REPLACE (CASE WHEN fare_event_time >= TIMESTAMP '2024-01-16' THEN fare_tip END AS fare_tip)
            FROM ({_PAIRS})""",
        "stream_rides_waiting": _WAITING,
        "stream_rides_fares_batches": _PAIRS,
        "stream_rides_waiting_batches": _WAITING,
        "stream_rides_fares_begun": _PAIRS,
        "stream_enrichment_fastest": _expired(
            moved_by="greatest", chosen="(event_type = 'purchase' OR ts < TIMESTAMP '2024-01-16')") + _OUTCOMES,
        "stream_enrichment": _expired() + _OUTCOMES,
        "stream_enrichment_emit": _expired(replaced=True) + _OUTCOMES,
        "stream_unmatched_fares": _expired() + _STREAM_UNMATCHED.format(kind="fare", more=", e.value AS tip"),
        "stream_unmatched_rides": _expired() + _STREAM_UNMATCHED.format(kind="ride", more=""),
        "stream_rides_fares_within": f"""{_UNIQUE}
            SELECT f.ride_id, {_FLAT} FROM fare f JOIN ride r ON {_NEAR}""",
        "stream_unmatched_fares_within": f"""{_UNIQUE}
            SELECT * FROM fare f
            WHERE NOT EXISTS (FROM ride r WHERE {_NEAR}) AND {_GIVEN_UP}""",
    }
