"""SQL views of the given tables, as common table expressions for the counterpart queries."""

from __future__ import annotations

from delaylab.functions.text import DELAY_LABELS
from delaylab.sources.testbed import CARRIERS


def _carrier(key: str, last: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{code}'" for i, code in enumerate(CARRIERS))
    return f"CASE CAST({key} % 10 AS INT) {whens} ELSE '{last}' END"


def delay_class(minutes: str) -> str:
    return (
        f"CAST(CASE WHEN {minutes} < -15 THEN 0 WHEN {minutes} < 0 THEN 1 "
        f"WHEN {minutes} < 30 THEN 2 WHEN {minutes} IS NOT NULL THEN 3 END AS DOUBLE)"
    )


def delay_label(klass: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{text}'" for i, text in enumerate(DELAY_LABELS))
    return f"CASE CAST({klass} AS INT) {whens} END"


def clock(date: str, hhmm: str) -> str:
    padded = f"lpad({hhmm}, 4, '0')"
    return (
        f"CASE WHEN substr({padded}, 1, 2) = '24' "
        f"THEN CAST({date} || ' 23:59:00' AS TIMESTAMP) "
        f"ELSE CAST({date} || ' ' || substr({padded}, 1, 2) || ':' || substr({padded}, 3, 2) "
        f"|| ':00' AS TIMESTAMP) END"
    )


VIEWS: dict[str, str] = {
    "flights": f"""
SELECT CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) AS FlightDate,
  CAST(year(l.l_shipdate) AS INT) AS Year, CAST(month(l.l_shipdate) AS INT) AS Month,
  CAST(day(l.l_shipdate) AS INT) AS DayofMonth, CAST(isodow(l.l_shipdate) AS INT) AS DayOfWeek,
  {_carrier('l.l_suppkey', 'OO')} AS Carrier,
  CAST(l.l_orderkey % 5000 AS VARCHAR) AS FlightNum,
  concat('N', lpad(CAST(l.l_partkey AS VARCHAR), 6, '0')) AS TailNum,
  concat('A', lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0')) AS Origin,
  concat('A', lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0')) AS Dest,
  CAST(100 + ((s.s_nationkey * 37 + c.c_nationkey * 53) % 25) * 100 + l.l_linenumber % 3 AS DOUBLE) AS Distance,
  CASE WHEN l.l_partkey % 50 = 7 THEN NULL ELSE CAST((l.l_partkey * 7 + l.l_orderkey * 13) % 120 - 30 AS DOUBLE) END AS DepDelay,
  CASE WHEN l.l_partkey % 50 IN (7, 8) THEN NULL ELSE CAST((l.l_partkey * 7 + l.l_orderkey * 13) % 120 - 30 + (l.l_orderkey * 31 + l.l_suppkey * 17) % 41 - 20 AS DOUBLE) END AS ArrDelay,
  lpad(CAST((l.l_orderkey * 7 % 25) * 100 + l.l_partkey % 60 AS VARCHAR), 4, '0') AS CRSDepTime,
  lpad(CAST(((l.l_orderkey * 7 + 3) % 25) * 100 + l.l_suppkey % 60 AS VARCHAR), 4, '0') AS CRSArrTime,
  lpad(CAST((l.l_orderkey * 7 % 24) * 100 + l.l_partkey % 60 AS VARCHAR), 4, '0') AS DepTime,
  lpad(CAST(((l.l_orderkey * 7 + 3) % 24) * 100 + l.l_suppkey % 60 AS VARCHAR), 4, '0') AS ArrTime,
  CAST(30 + (l.l_orderkey + l.l_linenumber) % 300 AS DOUBLE) AS AirTime
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "requests": f"""
SELECT concat('req-', CAST(event_id AS VARCHAR)) AS UUID, ts AS Timestamp,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS FlightDate,
  {_carrier('user_id', 'ZZ')} AS Carrier,
  CAST(event_id % 5000 AS VARCHAR) AS FlightNum,
  concat('A', lpad(CAST(user_id % 26 AS VARCHAR), 2, '0')) AS Origin,
  concat('A', lpad(CAST(event_id % 25 AS VARCHAR), 2, '0')) AS Dest,
  CAST(event_id % 120 - 30 AS DOUBLE) AS DepDelay,
  event_type <> 'error' AS responded
FROM events""",
    "airplanes": """
SELECT concat('N', lpad(CAST(p_partkey AS VARCHAR), 6, '0')) AS TailNum,
  concat('Owner', lpad(CAST(p_partkey % 17 AS VARCHAR), 2, '0')) AS Owner,
  concat('S', lpad(CAST(p_partkey % 50 AS VARCHAR), 2, '0')) AS OwnerState,
  p_brand AS Manufacturer, p_type AS Model, CAST(1970 + p_size AS VARCHAR) AS ManufacturerYear,
  CAST(p_partkey * 11 AS VARCHAR) AS SerialNumber,
  concat('Eng', CAST(p_partkey % 6 AS VARCHAR)) AS EngineManufacturer,
  concat('EM-', CAST(p_size % 9 AS VARCHAR)) AS EngineModel
FROM part""",
    "airlines": """
SELECT Carrier AS CarrierCode, concat('Airline ', Carrier) AS Name,
  concat('https://', lower(Carrier), '.example.org') AS url,
  concat(lower(Carrier), '.example.org') AS domain,
  concat(lower(Carrier), '.png') AS logo_url, concat('Summary of ', Carrier) AS summary
FROM (SELECT DISTINCT Carrier FROM flights)""",
    "features": f"""
SELECT ArrDelay, CASE WHEN arr < dep THEN arr + INTERVAL 1 DAY ELSE arr END AS CRSArrTime,
  dep AS CRSDepTime, Carrier, DayofMonth AS DayOfMonth,
  CAST(DayOfWeek - 1 AS INT) AS DayOfWeek,
  CAST(dayofyear(CAST(FlightDate AS DATE)) AS INT) AS DayOfYear, DepDelay, Dest, Distance,
  FlightDate, FlightNum, Origin
FROM (SELECT *, {clock('FlightDate', 'CRSDepTime')} AS dep, {clock('FlightDate', 'CRSArrTime')} AS arr
  FROM flights WHERE ArrDelay IS NOT NULL AND DepDelay IS NOT NULL)""",
    "distances": """
SELECT Origin, Dest, avg(Distance) AS Distance FROM flights GROUP BY Origin, Dest""",
    "prepared": """
SELECT r.UUID, r.Timestamp, r.FlightDate, r.Carrier, r.FlightNum, r.Origin, r.Dest, r.DepDelay,
  r.responded, coalesce(d.Distance, 0.0) AS Distance, d.Distance IS NULL AS distance_missing,
  CAST(dayofyear(CAST(r.FlightDate AS DATE)) AS INT) AS DayOfYear,
  CAST(day(CAST(r.FlightDate AS DATE)) AS INT) AS DayOfMonth,
  CAST(isodow(CAST(r.FlightDate AS DATE)) - 1 AS INT) AS DayOfWeek
FROM requests r LEFT JOIN distances d ON r.Origin = d.Origin AND r.Dest = d.Dest""",
    "scored": f"""
SELECT *, Origin || '-' || Dest AS Route, {delay_class('DepDelay')} AS Prediction
FROM prepared""",
    "responses": """
SELECT UUID AS uuid, Origin AS origin, Dest AS dest, Carrier AS carrier,
  FlightDate AS flight_date, DepDelay AS dep_delay, Distance AS distance,
  CAST(Prediction AS INT) AS prediction, Timestamp AS "timestamp"
FROM scored""",
    "message_log": """
SELECT 'requests' AS topic, CAST(user_id % 4 AS INT) AS part, event_id AS off, props AS value
FROM events""",
    "fleet_rows": """
SELECT *, (row_number() OVER (PARTITION BY Carrier ORDER BY TailNum) - 1) // 10000 AS Part,
  count(*) OVER (PARTITION BY Carrier) AS FleetCount
FROM (SELECT DISTINCT Carrier, TailNum FROM flights)""",
    "fleet": """
SELECT Carrier, FleetCount, CAST(Part AS BIGINT) AS Part,
  string_agg(TailNum, ';' ORDER BY TailNum) AS TailNumbers
FROM fleet_rows GROUP BY Carrier, FleetCount, Part""",
    "airplane_rows": """
SELECT TailNum, Carrier, FlightDate, FlightNum, Origin, Dest,
  (row_number() OVER (PARTITION BY TailNum ORDER BY Carrier, FlightDate, FlightNum, Origin, Dest) - 1)
    // 10000 AS Part,
  count(*) OVER (PARTITION BY TailNum) AS FlightCount
FROM flights""",
    "airplane_flights": """
SELECT TailNum, FlightCount, CAST(Part AS BIGINT) AS Part,
  string_agg(concat_ws('|', Carrier, FlightDate, FlightNum, Origin, Dest), ';'
    ORDER BY Carrier, FlightDate, FlightNum, Origin, Dest) AS Flights
FROM airplane_rows GROUP BY TailNum, FlightCount, Part""",
}

_NEEDS = {
    "airlines": ["flights"],
    "features": ["flights"],
    "distances": ["flights"],
    "prepared": ["requests", "distances"],
    "scored": ["prepared"],
    "responses": ["scored"],
    "fleet_rows": ["flights"],
    "fleet": ["fleet_rows"],
    "airplane_rows": ["flights"],
    "airplane_flights": ["airplane_rows"],
}


def over(views: list[str], body: str) -> str:
    """``body`` with the named views, and those they need, in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered) + "\n" + body
