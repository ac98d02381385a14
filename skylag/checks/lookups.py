"""Registered queries: distances, searches, pages, summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from skylag.checks import sql
from skylag.checks.common import distances, flights
from skylag.operators import daystates, lookups, summaries
from skylag.operators import distances as dist
from skylag.schemas import DISTANCES
from skylag.session import tune, work_path
from skylag.sinks import files, folders, zorder
from skylag.sources import tables, testbed

QUERIES = {}
ORACLE = {}

# Distances.

QUERIES["route_distances"] = distances
ORACLE["route_distances"] = f"WITH {sql.DISTANCES} SELECT * FROM distances"


def distinct_routes(spark, sf_dir):
    return dist.distinct_rows(flights(spark, sf_dir).select(*dist.ROUTE))


QUERIES["distinct_routes"] = distinct_routes
ORACLE["distinct_routes"] = f'WITH {sql.FLIGHTS} SELECT DISTINCT "Origin", "Dest" FROM flights'


def longest_routes(spark, sf_dir):
    return dist.by_distance(distances(spark, sf_dir), ascending=False).limit(20)


QUERIES["longest_routes"] = longest_routes
ORACLE["longest_routes"] = f"""WITH {sql.DISTANCES}
SELECT * FROM distances ORDER BY "Distance" DESC, "Origin", "Dest" LIMIT 20"""


def route_distance(spark, sf_dir):
    return dist.route_distance(distances(spark, sf_dir), "A03", "A07")


QUERIES["route_distance"] = route_distance
ORACLE["route_distance"] = f"""WITH {sql.DISTANCES}
SELECT "Distance" FROM distances WHERE "Origin" = 'A03' AND "Dest" = 'A07'"""


def distance_lookup_table(spark, sf_dir):
    """Through the stored table, whose names a store folds to lower case."""
    path = work_path(spark, "distances")
    folded = distances(spark, sf_dir).toDF("origin", "dest", "distance")
    files.write_clustered(folded, path, ["origin", "dest"])
    return tables.read_distances(spark, path)


QUERIES["distance_lookup_table"] = distance_lookup_table
ORACLE["distance_lookup_table"] = ORACLE["route_distances"]


def upsert_distances(spark, sf_dir):
    """Changes from all flights: routes rewritten many times, and new routes."""
    known = distances(spark, sf_dir)
    changes = flights(spark, sf_dir).select(
        "Origin",
        F.when(F.col("Month") <= 6, F.col("Dest")).otherwise(
            F.concat(F.lit("X"), F.col("Dest"))
        ).alias("Dest"),
        F.when(F.col("DayofMonth") != 7, F.col("Distance") + F.col("DayofMonth")).alias("Distance"),
        F.concat_ws(" ", "FlightDate", "FlightNum").alias("seq"),
    )
    return dist.upsert(known, dist.select_distances(changes, "seq"), dist.ROUTE, seq="seq")


QUERIES["upsert_distances"] = upsert_distances
ORACLE["upsert_distances"] = f"""WITH {sql.DISTANCES},
changes AS (
  SELECT "Origin", CASE WHEN "Month" <= 6 THEN "Dest" ELSE concat('X', "Dest") END AS "Dest",
    CASE WHEN "DayofMonth" <> 7 THEN "Distance" + "DayofMonth" ELSE 0.0 END AS "Distance",
    concat("FlightDate", ' ', "FlightNum") AS seq, 1 AS w
  FROM flights
),
both_sides AS (
  SELECT * FROM changes UNION ALL
  SELECT "Origin", "Dest", "Distance", '' AS seq, 0 AS w FROM distances
)
SELECT "Origin", "Dest", "Distance" FROM (
  SELECT *, row_number() OVER (PARTITION BY "Origin", "Dest" ORDER BY w DESC, seq DESC, "Distance" DESC) AS rn
  FROM both_sides
) WHERE rn = 1"""

# Searches and pages.


def search_flights(spark, sf_dir):
    return lookups.search_flights(
        flights(spark, sf_dir), Carrier="C11", Origin="A03", TailNum=None
    )


QUERIES["search_flights"] = search_flights
ORACLE["search_flights"] = f"""WITH {sql.FLIGHTS}
SELECT * FROM flights WHERE "Carrier" = 'C11' AND "Origin" = 'A03'"""

_PAGE_ORDER = lookups.FLIGHT_ORDER + [
    c for c in sql.FLIGHT_COLUMNS if c not in lookups.FLIGHT_ORDER
]


def _flights_page_sql(where, start, size):
    return f"""WITH {sql.FLIGHTS}, hits AS (SELECT * FROM flights WHERE {where})
SELECT *, (SELECT count(*) FROM hits) AS total FROM hits
ORDER BY {sql.first_by(_PAGE_ORDER)} LIMIT {size} OFFSET {start}"""


def search_flights_page(spark, sf_dir):
    return lookups.flights_page(flights(spark, sf_dir), start=30, Carrier="C11")


QUERIES["search_flights_page"] = search_flights_page
ORACLE["search_flights_page"] = _flights_page_sql("\"Carrier\" = 'C11'", 30, 15)


def search_flights_far_page(spark, sf_dir):
    """A page of a stored order of all flights from a place."""
    path = work_path(spark, "order")
    hits = lookups.search_flights(flights(spark, sf_dir), Origin="A05")
    lookups.write_order(hits, path, lookups.FLIGHT_ORDER)
    return lookups.stored_page(spark, path, lookups.FLIGHT_ORDER, 150, 15)


QUERIES["search_flights_far_page"] = search_flights_far_page
ORACLE["search_flights_far_page"] = f"""WITH {sql.FLIGHTS}
SELECT * FROM flights WHERE "Origin" = 'A05'
ORDER BY {sql.first_by(_PAGE_ORDER)} LIMIT 15 OFFSET 150"""


def page_bounds(spark, sf_dir):
    found = lookups.flights_page(flights(spark, sf_dir), start=15, Dest="A09")
    rows = lookups.page_bounds(found, 15, 30, 15)
    return rows.select(
        "FlightDate", "FlightNum", "total", "next_bottom", "next_top",
        "previous_bottom", "previous_top", "next_link", "previous_link",
    )


QUERIES["page_bounds"] = page_bounds
ORACLE["page_bounds"] = f"""WITH {sql.FLIGHTS}, hits AS (SELECT * FROM flights WHERE "Dest" = 'A09')
SELECT "FlightDate", "FlightNum", (SELECT count(*) FROM hits) AS total,
  CAST(30 AS INT) AS next_bottom, CAST(45 AS INT) AS next_top,
  CAST(0 AS INT) AS previous_bottom, CAST(15 AS INT) AS previous_top,
  (SELECT count(*) FROM hits) > 30 AS next_link, (SELECT count(*) FROM hits) > 0 AS previous_link
FROM hits ORDER BY {sql.first_by(_PAGE_ORDER)} LIMIT 15 OFFSET 15"""

_OWNER = "small red widget"
_MODEL = "economy"


def search_airplanes(spark, sf_dir):
    planes = testbed.airplanes(tune(spark), sf_dir)
    return lookups.search_airplanes(planes, Owner=_OWNER, Model=_MODEL)


_WORDS = "[w FOR w IN regexp_split_to_array(lower({c}), '[^\\p{{L}}\\p{{N}}]+') IF w <> '']"


def _matched(column, value):
    wanted = "[" + ", ".join(f"'{w}'" for w in value.split()) + "]"
    return f"len(list_intersect({_WORDS.format(c=column)}, {wanted}))"


_AIRPLANE_HITS = f"""{sql.AIRPLANES},
scored AS (
  SELECT *, {_matched('"Owner"', _OWNER)} AS a, {_matched('"Model"', _MODEL)} AS b FROM airplanes
),
hits AS (
  SELECT {sql.cols(sql.AIRPLANE_COLUMNS)}, CAST(a + b AS INT) AS "Relevance"
  FROM scored WHERE a > 0 AND b > 0
)"""

QUERIES["search_airplanes"] = search_airplanes
ORACLE["search_airplanes"] = f"WITH {_AIRPLANE_HITS} SELECT * FROM hits"


def search_airplanes_page(spark, sf_dir):
    planes = testbed.airplanes(tune(spark), sf_dir)
    return lookups.airplanes_page(planes, start=5, Owner=_OWNER, Model=_MODEL)


QUERIES["search_airplanes_page"] = search_airplanes_page
ORACLE["search_airplanes_page"] = f"""WITH {_AIRPLANE_HITS}
SELECT *, (SELECT count(*) FROM hits) AS total FROM hits
ORDER BY "Owner", "Relevance" DESC, {sql.cols([c for c in sql.AIRPLANE_COLUMNS if c != "Owner"])}
LIMIT 5 OFFSET 5"""


# The same searches by the index, scored by BM25; the SQL scores every row.
_OWNER_MANY, _TYPE_MANY = "big small widget", "economy brushed tin"


def _bm25(field, text):
    """SQL of the hits (TailNum, s) of one field."""
    wanted = ", ".join(f"('{w}')" for w in text.split())
    words = _WORDS.format(c=f'"{field}"')
    return f"""(WITH docs AS (SELECT "TailNum", {words} AS ws FROM airplanes WHERE len({words}) > 0),
  size AS (SELECT count(*) AS n, avg(len(ws)) AS average FROM docs),
  tf AS (SELECT "TailNum", w, len(ws) AS length, len([x FOR x IN ws IF x = w]) AS tf FROM docs, (VALUES {wanted}) AS q(w)),
  df AS (SELECT w, count(*) AS df FROM tf WHERE tf > 0 GROUP BY w)
  SELECT "TailNum", sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / average))) AS s
  FROM tf JOIN df USING (w), size WHERE tf > 0 GROUP BY "TailNum")"""


def _indexed_hits(owner, kind):
    return f"""WITH {sql.AIRPLANES}, found AS (
  SELECT {sql.cols(sql.AIRPLANE_COLUMNS)}, round(a.s + b.s, 9) AS "Relevance"
  FROM airplanes JOIN {_bm25('Owner', owner)} a USING ("TailNum") JOIN {_bm25('Model', kind)} b USING ("TailNum")
)"""


def _indexed(spark, sf_dir):
    planes, path = testbed.airplanes(tune(spark), sf_dir), work_path(spark, "index")
    lookups.index_airplanes(planes, path)
    return planes, path


def indexed_airplanes(spark, sf_dir):
    planes, path = _indexed(spark, sf_dir)
    return lookups.indexed_airplanes(spark, path, planes, Owner=_OWNER_MANY, Model=_TYPE_MANY)


QUERIES["indexed_airplanes"] = indexed_airplanes
ORACLE["indexed_airplanes"] = f"{_indexed_hits(_OWNER_MANY, _TYPE_MANY)} SELECT * FROM found"


def indexed_airplanes_page(spark, sf_dir):
    planes, path = _indexed(spark, sf_dir)
    return lookups.indexed_airplanes_page(spark, path, planes, start=5, Owner=_OWNER, Model=_MODEL)


QUERIES["indexed_airplanes_page"] = indexed_airplanes_page
ORACLE["indexed_airplanes_page"] = f"""{_indexed_hits(_OWNER, _MODEL)}
SELECT *, (SELECT count(*) FROM found) AS total FROM found
ORDER BY "Owner", "Relevance" DESC, {sql.cols([c for c in sql.AIRPLANE_COLUMNS if c != "Owner"])} LIMIT 5 OFFSET 5"""


def best_airplanes(spark, sf_dir):
    """The ten best matches."""
    planes, path = _indexed(spark, sf_dir)
    return lookups.best_airplanes(spark, path, planes, 10, Owner=_OWNER_MANY, Model=_TYPE_MANY)


QUERIES["best_airplanes"] = best_airplanes
ORACLE["best_airplanes"] = f"""{_indexed_hits(_OWNER_MANY, _TYPE_MANY)}
SELECT * FROM found ORDER BY "Relevance" DESC, "TailNum" LIMIT 10"""


def upsert_folders(spark, sf_dir):
    """The changes of ``upsert_distances``, put in two steps into a table in folders."""
    return folders.read_folders(spark, _folder_table(spark, sf_dir), DISTANCES)


def _changes(spark, sf_dir):
    return flights(spark, sf_dir).select(
        "Origin",
        F.when(F.col("Month") <= 6, F.col("Dest")).otherwise(F.concat(F.lit("X"), F.col("Dest"))).alias("Dest"),
        F.when(F.col("DayofMonth") != 7, F.col("Distance") + F.col("DayofMonth")).alias("Distance"),
        F.concat_ws(" ", "FlightDate", "FlightNum").alias("seq"),
    )


def _folder_table(spark, sf_dir):
    path = work_path(spark, "folders")
    folders.upsert_table(distances(spark, sf_dir), path, DISTANCES, dist.ROUTE, buckets=16)
    changes = dist.select_distances(_changes(spark, sf_dir), "seq")
    for part in ("seq < '1995'", "seq >= '1995'"):
        folders.upsert_table(changes.where(part), path, DISTANCES, dist.ROUTE, seq="seq")
    return path


QUERIES["upsert_folders"] = upsert_folders
ORACLE["upsert_folders"] = ORACLE["upsert_distances"]


def folder_lookup(spark, sf_dir):
    """One route of that table, from the only folder it can lie in."""
    return folders.lookup(spark, _folder_table(spark, sf_dir), DISTANCES, Origin="A03", Dest="XA07")


QUERIES["folder_lookup"] = folder_lookup
ORACLE["folder_lookup"] = ORACLE["upsert_distances"] + " AND \"Origin\" = 'A03' AND \"Dest\" = 'XA07'"


def distances_by_year(spark, sf_dir):
    """Mean distances merged from years: all put with wrong distances first, then right,
    and a year without flights taken back."""
    path, rows = work_path(spark, "states"), flights(spark, sf_dir)
    years = [r[0] for r in rows.select("Year").distinct().orderBy("Year").collect()]
    wrong = rows.withColumn("Distance", F.col("Distance") * 2)
    extra = wrong.where(F.col("Year") == years[0]).withColumn("Year", F.lit(1900))
    daystates.put_periods(wrong.unionByName(extra), path, [*years, 1900], "Year")
    daystates.put_periods(rows, path, years[:2], "Year")
    daystates.put_periods(rows, path, [*years[2:], 1900], "Year")
    return daystates.merged_distances(spark, path)


QUERIES["distances_by_year"] = distances_by_year
ORACLE["distances_by_year"] = ORACLE["route_distances"]


def zorder_lookup(spark, sf_dir):
    """Flights to a place on a date, from a table stored by three keys, the first not given."""
    path = work_path(spark, "zorder")
    zorder.write_zordered(flights(spark, sf_dir), path, ["Origin", "Dest", "FlightDate"], files=16)
    return zorder.lookup(spark, path, Dest="A15", FlightDate=LIST_DAY)


LIST_DAY = "1996-02-02"
QUERIES["zorder_lookup"] = zorder_lookup
ORACLE["zorder_lookup"] = f"""WITH {sql.FLIGHTS}
SELECT * FROM flights WHERE "Dest" = 'A15' AND "FlightDate" = '{LIST_DAY}'"""


def get_flight(spark, sf_dir):
    return lookups.get_flight(flights(spark, sf_dir), "C17", "1998-09-05", "7005")


QUERIES["get_flight"] = get_flight
ORACLE["get_flight"] = f"""WITH {sql.FLIGHTS}
SELECT * FROM flights WHERE "Carrier" = 'C17' AND "FlightDate" = '1998-09-05' AND "FlightNum" = '7005'
ORDER BY {sql.first_by(sql.FLIGHT_COLUMNS)} LIMIT 1"""


def list_flights(spark, sf_dir):
    return lookups.list_flights(flights(spark, sf_dir), "A05", "A15", LIST_DAY)


QUERIES["list_flights"] = list_flights
ORACLE["list_flights"] = f"""WITH {sql.FLIGHTS}
SELECT *, count(*) OVER () AS total FROM flights
WHERE "Origin" = 'A05' AND "Dest" = 'A15' AND "FlightDate" = '{LIST_DAY}'"""

# Summaries.


def flights_by_month(spark, sf_dir):
    return summaries.flights_by_month(flights(spark, sf_dir))


QUERIES["flights_by_month"] = flights_by_month
ORACLE["flights_by_month"] = f"""WITH {sql.FLIGHTS}
SELECT "Year", "Month", count(*) AS total_flights FROM flights GROUP BY 1, 2 ORDER BY 1, 2"""

def flights_per_airplane(spark, sf_dir):
    return summaries.flights_per_airplane(flights(spark, sf_dir))


_PER_AIRPLANE = """SELECT "TailNum", "FlightDate", "FlightNum", "Carrier", "Origin", "Dest", count(*) AS "Copies"
FROM flights {where} GROUP BY 1, 2, 3, 4, 5, 6"""
QUERIES["flights_per_airplane"] = flights_per_airplane
ORACLE["flights_per_airplane"] = f"WITH {sql.FLIGHTS} " + _PER_AIRPLANE.format(where="")


def airplane_flights(spark, sf_dir):
    """The second page of one airplane, from the stored table."""
    path = work_path(spark, "airplanes")
    files.write_clustered(summaries.flights_per_airplane(flights(spark, sf_dir)), path, ["TailNum", *summaries.FLIGHT_ENTRY])
    return lookups.airplane_flights(spark.read.parquet(path), "N00042", 15)


QUERIES["airplane_flights"] = airplane_flights
ORACLE["airplane_flights"] = (
    f"WITH {sql.FLIGHTS} " + _PER_AIRPLANE.format(where="WHERE \"TailNum\" = 'N00042'")
    + ' ORDER BY "FlightDate", "FlightNum", "TailNum", "Carrier", "Origin", "Dest", "Copies" LIMIT 15 OFFSET 15'
)


def _fleets(spark, sf_dir):
    return summaries.airplanes_per_carrier(flights(spark, sf_dir))


QUERIES["airplanes_per_carrier"] = _fleets
ORACLE["airplanes_per_carrier"] = f"""WITH {sql.FLIGHTS}
SELECT DISTINCT "Carrier", "TailNum" FROM flights"""


def fleet_page(spark, sf_dir):
    return lookups.fleet_page(_fleets(spark, sf_dir), "C11", 10)


QUERIES["fleet_page"] = fleet_page
ORACLE["fleet_page"] = f"""WITH {sql.FLIGHTS}
SELECT DISTINCT "Carrier", "TailNum" FROM flights WHERE "Carrier" = 'C11' ORDER BY "TailNum" LIMIT 5 OFFSET 10"""


def list_carriers(spark, sf_dir):
    return lookups.list_carriers(_fleets(spark, sf_dir))


QUERIES["list_carriers"] = list_carriers
ORACLE["list_carriers"] = f"""WITH {sql.FLIGHTS}
SELECT "Carrier", count(DISTINCT "TailNum") AS "FleetCount" FROM flights GROUP BY 1"""


def airline_page(spark, sf_dir):
    return lookups.airline_page(testbed.airlines(tune(spark), sf_dir), _fleets(spark, sf_dir))


def airline_page_of_one(spark, sf_dir):
    return lookups.airline_page(testbed.airlines(tune(spark), sf_dir), _fleets(spark, sf_dir), "C11")


_AIRLINES = f"""WITH {sql.FLIGHTS},
airlines AS (SELECT DISTINCT concat('C', substr(p_brand, 7)) AS code, p_brand FROM part),
fleets AS (SELECT "Carrier" AS k, count(DISTINCT "TailNum") AS n FROM flights GROUP BY 1)
SELECT code AS "CarrierCode", p_brand AS "Name", concat('http://', lower(code), '.example') AS "url",
  concat(lower(code), '.example') AS "domain",
  concat('http://', lower(code), '.example/logo.png') AS "logo_url",
  concat('Carrier ', code) AS "summary", n AS "FleetCount"
FROM airlines LEFT JOIN fleets ON code = k"""
QUERIES["airline_page"] = airline_page
ORACLE["airline_page"] = _AIRLINES
QUERIES["airline_page_of_one"] = airline_page_of_one
ORACLE["airline_page_of_one"] = f"{_AIRLINES} WHERE code = 'C11'"


def manufacturer_totals(spark, sf_dir):
    return summaries.manufacturer_totals(testbed.airplanes(tune(spark), sf_dir))


QUERIES["manufacturer_totals"] = manufacturer_totals
ORACLE["manufacturer_totals"] = f"""WITH {sql.AIRPLANES}
SELECT "Manufacturer", count(*) AS "Total" FROM airplanes GROUP BY 1"""


def manufacturer_chart(spark, sf_dir):
    """The bars of the manufacturer chart."""
    totals = summaries.manufacturer_totals(testbed.airplanes(tune(spark), sf_dir))
    return summaries.chart_rows(totals, "Manufacturer", "Total")


QUERIES["manufacturer_chart"] = manufacturer_chart
ORACLE["manufacturer_chart"] = f"""WITH {sql.AIRPLANES}
SELECT "Manufacturer", count(*) AS "Total" FROM airplanes GROUP BY 1 ORDER BY 2 DESC, 1"""

# Nothing is that late: the last two bins have no flights.
_EDGES = [-15, 0, 15, 30, 60, 1000, 2000]


def delay_histogram(spark, sf_dir):
    return summaries.delay_histogram(flights(spark, sf_dir), _EDGES)


QUERIES["delay_histogram"] = delay_histogram
ORACLE["delay_histogram"] = f"""WITH {sql.FLIGHTS},
bins AS (SELECT * FROM (VALUES ('< -15', -1e9, -15), ('-15 to 0', -15, 0), ('0 to 15', 0, 15), ('15 to 30', 15, 30),
  ('30 to 60', 30, 60), ('60 to 1000', 60, 1000), ('1000 to 2000', 1000, 2000), ('>= 2000', 2000, 1e9)) AS b(label, low, high))
SELECT label, count("ArrDelay") AS value FROM bins LEFT JOIN flights ON "ArrDelay" >= low AND "ArrDelay" < high GROUP BY 1"""
