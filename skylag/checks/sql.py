"""The given tables read as flights, requests and so on, in plain SQL.

These texts mirror ``skylag.sources.testbed`` for another engine, so that every
query can be compared with one that shares no code with it.
"""

from __future__ import annotations


def _hhmm(m: str) -> str:
    return (
        f"CASE WHEN {m} = 0 THEN '2400' "
        f"ELSE lpad(CAST(({m} // 60) * 100 + {m} % 60 AS VARCHAR), 4, '0') END"
    )


FLIGHT_COLUMNS = [
    "Year", "Month", "DayofMonth", "DayOfWeek", "FlightDate", "Carrier", "TailNum",
    "FlightNum", "Origin", "Dest", "Distance", "DepDelay", "ArrDelay", "CRSDepTime",
    "CRSArrTime", "DepTime", "ArrTime", "AirTime",
]

FLIGHTS = f"""
base AS (
  SELECT l.*, s.s_nationkey AS sn, c.c_nationkey AS cn, p.p_brand,
    CAST(l.l_shipdate AS DATE) AS fd,
    CAST((l_orderkey * 7 + l_linenumber * 131) % 1440 AS INT) AS dm,
    CAST((l_orderkey * 7 + l_linenumber * 131 + 45 + l_suppkey % 300) % 1440 AS INT) AS am,
    CASE WHEN (l_orderkey + l_linenumber) % 41 <> 0 THEN l_quantity - 10 END AS dd,
    CASE WHEN (l_orderkey + l_linenumber) % 43 <> 0
      THEN l_quantity - 10 + (l_partkey % 61) - 30 END AS ad
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
flights AS (
  SELECT CAST(year(fd) AS INT) AS "Year", CAST(month(fd) AS INT) AS "Month",
    CAST(day(fd) AS INT) AS "DayofMonth", CAST(isodow(fd) AS INT) AS "DayOfWeek",
    CAST(fd AS VARCHAR) AS "FlightDate",
    concat('C', substr(p_brand, 7)) AS "Carrier",
    concat('N', lpad(CAST(l_partkey % 500 AS VARCHAR), 5, '0')) AS "TailNum",
    CAST(l_orderkey % 9000 + 1 AS VARCHAR) AS "FlightNum",
    concat('A', lpad(CAST(sn AS VARCHAR), 2, '0')) AS "Origin",
    concat('A', lpad(CAST(cn AS VARCHAR), 2, '0')) AS "Dest",
    CAST(100 + ((sn * 37 + cn * 53) % 25) * 100 + l_linenumber % 3 AS DOUBLE) AS "Distance",
    dd AS "DepDelay", ad AS "ArrDelay",
    {_hhmm("dm")} AS "CRSDepTime", {_hhmm("am")} AS "CRSArrTime",
    CASE WHEN dd IS NOT NULL THEN {_hhmm("((dm + CAST(dd AS INT) + 1440) % 1440)")} END AS "DepTime",
    CASE WHEN ad IS NOT NULL THEN {_hhmm("((am + CAST(ad AS INT) + 1440) % 1440)")} END AS "ArrTime",
    CAST(100 + ((sn * 37 + cn * 53) % 25) * 100 + l_linenumber % 3 AS DOUBLE) / 8 AS "AirTime"
  FROM base
)"""


def _schedule(hhmm: str) -> str:
    return (
        f"CAST(\"FlightDate\" AS TIMESTAMP) + to_minutes(CASE WHEN substr({hhmm}, 1, 2) = '24' "
        f"THEN 1439 ELSE CAST(substr({hhmm}, 1, 2) AS INT) * 60 + CAST(substr({hhmm}, 3) AS INT) END)"
    )


FEATURE_COLUMNS = [
    "ArrDelay", "CRSArrTime", "CRSDepTime", "Carrier", "DayOfMonth", "DayOfWeek",
    "DayOfYear", "DepDelay", "Dest", "Distance", "FlightDate", "FlightNum", "Origin",
]

FEATURES = f"""{FLIGHTS},
timed AS (
  SELECT *, {_schedule('"CRSDepTime"')} AS dep, {_schedule('"CRSArrTime"')} AS arr
  FROM flights WHERE "ArrDelay" IS NOT NULL AND "DepDelay" IS NOT NULL
),
features AS (
  SELECT "ArrDelay",
    CAST(CASE WHEN arr < dep THEN arr + INTERVAL 1 DAY ELSE arr END AS VARCHAR) AS "CRSArrTime",
    CAST(dep AS VARCHAR) AS "CRSDepTime",
    "Carrier", "DayofMonth" AS "DayOfMonth", "DayOfWeek",
    CAST(dayofyear(CAST("FlightDate" AS DATE)) AS INT) AS "DayOfYear",
    "DepDelay", "Dest", "Distance", "FlightDate", "FlightNum", "Origin"
  FROM timed
)"""

DISTANCES = f"""{FLIGHTS},
distances AS (
  SELECT "Origin", "Dest", avg("Distance") AS "Distance" FROM flights GROUP BY "Origin", "Dest"
)"""

AIRPLANES = """
airplanes AS (
  SELECT printf('N%05d', p_partkey) AS "TailNum",
    p_name AS "Owner", concat('S', p_size % 5) AS "OwnerState",
    concat('Maker ', substr(p_brand, 7)) AS "Manufacturer", p_type AS "Model",
    CAST(1980 + p_size % 40 AS VARCHAR) AS "ManufacturerYear",
    concat('S', p_partkey) AS "SerialNumber",
    concat('Engine ', p_partkey % 7) AS "EngineManufacturer",
    concat('E', p_partkey % 11) AS "EngineModel"
  FROM part
)"""

AIRPLANE_COLUMNS = [
    "TailNum", "Owner", "OwnerState", "Manufacturer", "Model", "ManufacturerYear",
    "SerialNumber", "EngineManufacturer", "EngineModel",
]

REQUESTS = """
requests AS (
  SELECT event_id, event_type, md5(CAST(event_id AS VARCHAR)) AS "UUID",
    concat('A', lpad(CAST(user_id % 25 AS VARCHAR), 2, '0')) AS "Origin",
    concat('A', lpad(CAST((user_id * 7 + event_id) % 26 AS VARCHAR), 2, '0')) AS "Dest",
    concat('C', event_id % 25 + 1) AS "Carrier",
    CAST(event_id % 9000 + 1 AS VARCHAR) AS "FlightNum",
    CAST(CAST(ts AS DATE) AS VARCHAR) AS "FlightDate",
    value - 15 AS "DepDelay",
    strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS "Timestamp",
    ts,
    CAST(dayofyear(ts) AS INT) AS "DayOfYear",
    CAST(day(ts) AS INT) AS "DayOfMonth",
    CAST(isodow(ts) - 1 AS INT) AS "DayOfWeek"
  FROM events
)"""

RESPONSES = """
responses AS (
  SELECT md5(CAST(event_id AS VARCHAR)) AS "UUID",
    ts + (event_id % 30) * INTERVAL '1' SECOND AS ts,
    CAST(event_id % 4 AS DOUBLE) AS "Prediction"
  FROM events
)"""

MIXED_RESPONSES = """
responses AS (
  SELECT md5(CAST(event_id AS VARCHAR)) AS "UUID",
    ts + (event_id % 30 + s) * INTERVAL '1' SECOND AS ts,
    CAST((event_id + p) % 4 AS DOUBLE) AS "Prediction"
  FROM events, (VALUES (0, 0), (0, 0), (4, 1), (-40, 2)) AS shift(s, p)
  WHERE event_id % 7 <> 0
)"""

# Requests with the distance of their route beside them.
ENRICHED = f"""{DISTANCES},{REQUESTS},
enriched AS (
  SELECT r.*, d."Distance" AS found, coalesce(d."Distance", 0.0) AS "Distance",
    concat(r."Origin", '-', r."Dest") AS "Route"
  FROM requests r LEFT JOIN distances d ON r."Origin" = d."Origin" AND r."Dest" = d."Dest"
)"""


def bucket(column: str) -> str:
    return (
        f"CAST(CASE WHEN {column} IS NULL THEN NULL WHEN {column} < -15 THEN 0 "
        f"WHEN {column} < 0 THEN 1 WHEN {column} < 30 THEN 2 ELSE 3 END AS DOUBLE)"
    )


def cols(names: list[str]) -> str:
    return ", ".join(f'"{n}"' for n in names)


def first_by(names: list[str]) -> str:
    return ", ".join(f'"{n}" NULLS FIRST' for n in names)
