"""The same answers in DuckDB SQL over the driver tables.

Each query is a chain of common table expressions; only those a query needs are included.
"""

from __future__ import annotations

import re

from checks.queries import comparable

# name -> SQL of the expression; later ones may use earlier ones.
CTES = {
    "states": """
        SELECT 1704067200 + (event_id // 50) * 20 AS snapshot_ts,
               CASE WHEN event_id % 50 = 7 THEN 'ffffff'
                    ELSE printf('%06x', ((event_id // 4500) * 50 + event_id % 50) % 16777215) END AS icao24,
               CASE event_id % 50 WHEN 13 THEN NULL WHEN 17 THEN '        '
                    ELSE '  CS' || (event_id % 40 + CASE WHEN event_type = 'signup' THEN 100 ELSE 0 END) || '  '
               END AS callsign,
               'NATION_' || (event_id % 25) AS origin_country,
               1704067199 + (event_id // 50) * 20 AS time_position,
               1704067199 + (event_id // 50) * 20 AS last_contact,
               CASE WHEN event_id % 101 <> 0 THEN 4e0 + (event_id * 104729 % 70001) / 1e4 END AS longitude,
               CASE WHEN event_id % 97 <> 0 THEN 50e0 + (event_id * 7919 % 30001) / 1e4 END AS latitude,
               CASE WHEN event_id % 7 <> 0 THEN (event_id * 37 % 40001) * 0.3048e0 END AS baro_altitude,
               CASE WHEN event_id % 53 <> 0 THEN event_type = 'view' END AS on_ground,
               CASE WHEN event_id % 89 <> 0 THEN value * 0.514444e0 END AS velocity,
               CASE WHEN event_id % 29 <> 0 THEN (event_id * 17 % 3600) / 10e0 END AS true_track,
               CASE WHEN event_id % 11 <> 0 THEN (event_id % 41 - 20) * 0.5e0 END AS vertical_rate,
               CASE WHEN event_id % 5 <> 0 THEN ((event_id * 31 % 43001) - 150) * 0.3048e0 END AS geo_altitude,
               lpad(CAST(event_id % 8000 AS VARCHAR), 4, '0') AS squawk,
               event_type = 'error' AS spi,
               CAST(event_id % 4 AS INTEGER) AS position_source,
               CASE WHEN event_type = 'purchase' THEN CAST(event_id % 20 AS INTEGER) END AS category
        FROM events""",
    "arrivals": """
        SELECT *, 2 * ((snapshot_ts - 1704067200) // 20) AS arrival FROM states
        UNION ALL BY NAME
        SELECT * REPLACE (velocity + 5 AS velocity), 2 * ((snapshot_ts - 1704067200) // 20) + 1 AS arrival
        FROM states WHERE ((snapshot_ts - 1704067200) // 20) % 3 = 0""",
    "faulty": """
        SELECT * REPLACE (CASE WHEN spi AND on_ground IS NULL THEN NULL ELSE icao24 END AS icao24,
                          CASE WHEN spi THEN -velocity ELSE velocity END AS velocity)
        FROM arrivals""",
    "first_arrivals": """
        SELECT * FROM arrivals QUALIFY arrival = min(arrival) OVER (PARTITION BY snapshot_ts)""",
    "airports": """
        SELECT s_suppkey, s_acctbal, 'ST' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS ident,
               CASE s_nationkey % 3 WHEN 0 THEN 'large_airport' WHEN 1 THEN 'medium_airport'
                    ELSE 'small_airport' END AS type,
               s_name AS name,
               49.5e0 + (s_suppkey * 7907 % 40001) / 1e4 AS latitude_deg,
               3.5e0 + (s_suppkey * 5003 % 80001) / 1e4 AS longitude_deg,
               CASE WHEN s_suppkey % 17 <> 3 THEN CAST(s_suppkey * 37 % 5000 - 100 AS DOUBLE) END AS elevation_ft
        FROM supplier""",
    "stations": """
        SELECT ident AS station_id, name, type AS station_type, latitude_deg AS lat, longitude_deg AS lon,
               round(elevation_ft * 0.3048e0, 1) AS h
        FROM airports
        WHERE type IN ('large_airport', 'medium_airport') AND latitude_deg BETWEEN 50 AND 53
          AND longitude_deg BETWEEN 4 AND 11 AND elevation_ft IS NOT NULL""",
    "station_xyz": """
        SELECT *, (n + h) * cos(radians(lat)) * cos(radians(lon)) AS station_x,
               (n + h) * cos(radians(lat)) * sin(radians(lon)) AS station_y,
               (n * (1e0 - 0.0066943799901413165e0) + h) * sin(radians(lat)) AS station_z
        FROM (SELECT *, 6378137e0 / sqrt(1e0 - 0.0066943799901413165e0 * pow(sin(radians(lat)), 2)) AS n
              FROM stations)""",
    "clean": """
        SELECT * REPLACE (coalesce(vertical_rate, 0e0) AS vertical_rate)
        FROM (SELECT *, coalesce(geo_altitude, baro_altitude, 0e0) AS height FROM states)
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND velocity IS NOT NULL AND height >= 0""",
    "air": """
        SELECT *, CASE WHEN height < 11000 THEN 288.15e0 - 0.0065e0 * height ELSE 216.65e0 END AS temperature
        FROM clean""",
    "points": """
        SELECT *, sqrt(pow(x_ecef, 2) + pow(y_ecef, 2) + pow(z_ecef, 2)) AS r_to_earth
        FROM (SELECT *, (n + height) * cos(radians(latitude)) * cos(radians(longitude)) AS x_ecef,
                     (n + height) * cos(radians(latitude)) * sin(radians(longitude)) AS y_ecef,
                     (n * (1e0 - 0.0066943799901413165e0) + height) * sin(radians(latitude)) AS z_ecef,
                     velocity / sqrt(1.4e0 * 287.05e0 * temperature) AS mach,
                     CASE WHEN on_ground THEN 'ground' WHEN vertical_rate > 2.5 THEN 'climb'
                          WHEN vertical_rate < -2.5 THEN 'descent' ELSE 'cruise' END AS flight_phase,
                     (snapshot_ts // 60) * 60 AS time_window,
                     make_timestamp(snapshot_ts * 1000000) AS event_time
              FROM (SELECT *, 6378137e0 / sqrt(1e0 - 0.0066943799901413165e0 * pow(sin(radians(latitude)), 2)) AS n
                    FROM air))""",
    "best": """
        SELECT icao24, snapshot_ts,
               min({'r': sqrt(pow(x_ecef - station_x, 2) + pow(y_ecef - station_y, 2) + pow(z_ecef - station_z, 2)),
                    'station_id': station_id}) AS b
        FROM points CROSS JOIN station_xyz GROUP BY ALL""",
    "wide": """
        SELECT p.icao24, trim(callsign) AS callsign, origin_country, p.snapshot_ts, event_time, time_window,
               flight_phase, on_ground, latitude, longitude, height, x_ecef, y_ecef, z_ecef, velocity, mach,
               vertical_rate, true_track, r_to_earth, b.r AS r_to_station, s.station_id, s.name AS station_name,
               s.lat AS station_lat, s.lon AS station_lon, s.h AS station_h,
               TIMESTAMP '2024-06-01 00:00:00' AS event_ts
        FROM points p JOIN best USING (icao24, snapshot_ts) JOIN stations s ON s.station_id = b.station_id""",
    "dominant": """
        SELECT icao24, station_id AS dominant_station
        FROM (SELECT icao24, station_id, count(snapshot_ts) AS n FROM wide GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY n DESC, station_id) = 1""",
    "flights": """
        SELECT TIMESTAMP '2024-06-01 00:00:00' AS event_ts, icao24, callsign, origin_country, total_points,
               make_timestamp(a * 1000000) AS first_seen, make_timestamp(z * 1000000) AS last_seen,
               z - a AS tracked_sec, max_height, max_velocity, max_mach, avg_velocity, min_r_to_station,
               avg_r_to_station, round(avg_velocity * (z - a) / 1000, 1) AS distance_km, dominant_station
        FROM (SELECT icao24, callsign, origin_country, count(snapshot_ts) AS total_points, min(snapshot_ts) AS a,
                     max(snapshot_ts) AS z, max(height) AS max_height, max(velocity) AS max_velocity,
                     max(mach) AS max_mach, avg(velocity) AS avg_velocity, min(r_to_station) AS min_r_to_station,
                     avg(r_to_station) AS avg_r_to_station
              FROM wide GROUP BY ALL)
        LEFT JOIN dominant USING (icao24)""",
    "minutes": """
        SELECT TIMESTAMP '2024-06-01 00:00:00' AS event_ts, make_timestamp(time_window * 1000000) AS time_window,
               flight_phase, count(snapshot_ts) AS points_in_window, count(DISTINCT icao24) AS flights_in_window,
               avg(height) AS avg_height, avg(velocity) AS avg_velocity, avg(mach) AS avg_mach,
               avg(r_to_station) AS avg_r_to_station
        FROM wide GROUP BY time_window, flight_phase""",
    "facts": """
        SELECT event_ts, icao24, station_id, event_time AS snapshot_time,
               make_timestamp(time_window * 1000000) AS time_window, flight_phase, CAST(on_ground AS INTEGER) AS on_ground,
               latitude, longitude, height, x_ecef, y_ecef, z_ecef, velocity, mach, vertical_rate, true_track,
               r_to_earth, r_to_station
        FROM wide""",
    "store": """
        SELECT *, 1 AS load_seq FROM facts
        UNION ALL BY NAME
        SELECT * REPLACE (TIMESTAMP '2024-06-01 01:00:00' AS event_ts, velocity + 1 AS velocity), 2 AS load_seq
        FROM facts WHERE flight_phase <> 'cruise'
        UNION ALL BY NAME
        SELECT * EXCLUDE (range) REPLACE (TIMESTAMP '2024-06-01 01:00:00' AS event_ts, velocity + 2 AS velocity), 3 AS load_seq
        FROM facts CROSS JOIN range(2) WHERE flight_phase = 'descent'""",
    "newest_facts": """
        SELECT * EXCLUDE (load_seq) FROM store
        QUALIFY row_number() OVER (PARTITION BY icao24, snapshot_time ORDER BY event_ts DESC, load_seq DESC) = 1""",
    "flight_store": """
        SELECT *, 1 AS load_seq FROM flights
        UNION ALL BY NAME
        SELECT * REPLACE (TIMESTAMP '2024-06-01 01:00:00' AS event_ts, total_points + 1 AS total_points), 2 AS load_seq
        FROM flights WHERE total_points >= 5""",
    "newest_flights": """
        SELECT * EXCLUDE (load_seq) FROM flight_store
        QUALIFY row_number() OVER (PARTITION BY icao24, first_seen ORDER BY event_ts DESC, load_seq DESC) = 1""",
    "minute_store": """
        SELECT *, 1 AS load_seq FROM minutes
        UNION ALL BY NAME
        SELECT * REPLACE (TIMESTAMP '2024-06-01 01:00:00' AS event_ts, points_in_window + 1 AS points_in_window), 2 AS load_seq
        FROM minutes WHERE flight_phase = 'climb'""",
    "newest_minutes": """
        SELECT * EXCLUDE (load_seq) FROM minute_store
        QUALIFY row_number() OVER (PARTITION BY time_window, flight_phase ORDER BY event_ts DESC, load_seq DESC) = 1""",
    "crowd_sites": """
        SELECT *, (n + h) * cos(radians(lat)) * cos(radians(lon)) AS station_x,
               (n + h) * cos(radians(lat)) * sin(radians(lon)) AS station_y,
               (n * (1e0 - 0.0066943799901413165e0) + h) * sin(radians(lat)) AS station_z
        FROM (SELECT *, 6378137e0 / sqrt(1e0 - 0.0066943799901413165e0 * pow(sin(radians(lat)), 2)) AS n
              FROM (SELECT 'V' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS station_id,
                           52e0 + (s_suppkey * 7907 % 10007) / 1e6 AS lat, 6e0 + (s_suppkey * 5003 % 15013) / 1e6 AS lon,
                           CAST(s_suppkey % 30 AS DOUBLE) AS h
                    FROM supplier))""",
    "crowd_points": """
        SELECT *, (n + h) * cos(radians(lat)) * cos(radians(lon)) AS x, (n + h) * cos(radians(lat)) * sin(radians(lon)) AS y,
               (n * (1e0 - 0.0066943799901413165e0) + h) * sin(radians(lat)) AS z
        FROM (SELECT *, 6378137e0 / sqrt(1e0 - 0.0066943799901413165e0 * pow(sin(radians(lat)), 2)) AS n
              FROM (SELECT icao24, snapshot_ts, 52e0 + (snapshot_ts * 7919 + position_source * 911) % 10007 / 1e6 AS lat,
                           6e0 + (snapshot_ts * 104729 + ('0x' || icao24)::BIGINT * 31) % 15013 / 1e6 AS lon,
                           CAST(3000 + ('0x' || icao24)::BIGINT % 20 AS DOUBLE) AS h
                    FROM states))""",
    "crowd_best": """
        SELECT icao24, snapshot_ts,
               min({'r': sqrt(pow(x - station_x, 2) + pow(y - station_y, 2) + pow(z - station_z, 2)), 'station_id': station_id}) AS b
        FROM crowd_points CROSS JOIN crowd_sites GROUP BY ALL""",
    "last_seen": """
        SELECT icao24, callsign, origin_country, snapshot_ts AS last_ts FROM wide
        QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY snapshot_ts DESC) = 1""",
    "old_flights": """
        SELECT icao24, callsign, origin_country, snapshot_ts AS last_ts, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
        FROM wide WHERE flight_phase = 'ground' AND origin_country > 'NATION_12'
        QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY snapshot_ts DESC) = 1""",
    "loaded_flights": """
        SELECT icao24, callsign, origin_country, snapshot_ts AS last_ts, TIMESTAMP '2024-06-01 00:00:00' AS updated_at
        FROM wide WHERE origin_country < 'NATION_2'
        QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY snapshot_ts DESC) = 1""",
    "all_flights": """
        SELECT *, TIMESTAMP '2024-06-01 00:00:00' AS updated_at FROM last_seen""",
    "new_flights": """
        SELECT * FROM loaded_flights""",
    "dim_flight": """
        SELECT * FROM new_flights
        UNION ALL
        SELECT * FROM old_flights o WHERE NOT EXISTS (SELECT 1 FROM new_flights n WHERE n.icao24 = o.icao24)""",
    "old_open": """
        SELECT s_suppkey + 1 AS station_sk, ident AS station_id, name, type AS station_type, latitude_deg AS lat,
               longitude_deg AS lon,
               round(elevation_ft * 0.3048e0, 1) + CASE WHEN s_acctbal > 5000 THEN 1 ELSE 0 END AS h,
               '2024-01-01 00:00:00' AS valid_from, '9999-12-31 23:59:59' AS valid_to, true AS is_current
        FROM airports
        WHERE s_acctbal >= 0 AND s_suppkey % 5 <> 0 AND type IN ('large_airport', 'medium_airport') AND elevation_ft IS NOT NULL""",
    "old_closed": """
        SELECT o.* REPLACE (station_sk + 1000000000 AS station_sk, h + 2 AS h, '2023-01-01 00:00:00' AS valid_from,
                            '2024-01-01 00:00:00' AS valid_to, false AS is_current)
        FROM old_open o JOIN airports a ON a.ident = o.station_id WHERE s_acctbal > 8000""",
    "matched": """
        SELECT o.*, s.station_id IS NULL OR s.lat <> o.lat OR s.lon <> o.lon OR s.h <> o.h OR s.name <> o.name
                    OR s.station_type <> o.station_type AS ends
        FROM old_open o LEFT JOIN stations s USING (station_id)""",
    "opened": """
        SELECT * FROM stations s
        WHERE NOT EXISTS (SELECT 1 FROM matched m WHERE m.station_id = s.station_id AND NOT coalesce(m.ends, false))""",
    "dim_station": """
        SELECT * FROM old_closed
        UNION ALL BY NAME
        SELECT * EXCLUDE (ends) REPLACE (CASE WHEN ends THEN '2024-06-01 00:00:00' ELSE valid_to END AS valid_to,
                                         NOT coalesce(ends, false) AS is_current) FROM matched
        UNION ALL BY NAME
        SELECT NULL AS station_sk,
               station_id, name, station_type, lat, lon, h, '2024-06-01 00:00:00' AS valid_from,
               '9999-12-31 23:59:59' AS valid_to, true AS is_current
        FROM opened""",
    "obt": """
        SELECT f.*, coalesce(d.callsign, '') AS callsign, coalesce(d.origin_country, '') AS origin_country,
               coalesce(s.name, '') AS station_name, coalesce(s.station_type, '') AS station_type,
               coalesce(s.lat, 0) AS station_lat, coalesce(s.lon, 0) AS station_lon, coalesce(s.h, 0) AS station_h
        FROM newest_facts f LEFT JOIN old_flights d ON d.icao24 = f.icao24
        LEFT JOIN old_open s ON s.station_id = f.station_id""",
}

STATES_COLUMNS = (
    "snapshot_ts icao24 callsign origin_country time_position last_contact longitude latitude baro_altitude on_ground "
    "velocity true_track vertical_rate geo_altitude squawk spi position_source category"
).split()
EXACT = set(
    "snapshot_ts icao24 callsign origin_country time_position last_contact on_ground squawk spi position_source "
    "category last_ts station_id name station_type station_name event_time event_ts time_window snapshot_time flight_phase "
    "total_points first_seen last_seen tracked_sec dominant_station points_in_window flights_in_window arrival date "
    "month load_seq points facts aircraft snapshots requests rule violations input dimension copies updated_at "
    "station_sk valid_from valid_to is_current minute total_flights empty_refused missing_refused".split()
)


def pick(source: str, columns: str | list[str], tail: str = "") -> str:
    """SELECT with the comparison's rounding; ``a=expr`` names an expression."""
    items = []
    for column in columns if isinstance(columns, list) else columns.split():
        name, _, expression = column.partition("=")
        expression = expression or name
        items.append(f"{expression} AS {name}" if name in EXACT else comparable(name, expression))
    return f"SELECT {', '.join(items)} FROM {source} {tail}"


def with_ctes(sql: str) -> str:
    """Prefix the common table expressions that ``sql`` uses, directly or not."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(sql)
    if not needed:
        return sql
    body = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in CTES if name in needed)
    return f"WITH {body}\n{sql}"


STATES = " ".join(STATES_COLUMNS)
STATIONS = "station_id name station_type lat lon h"
WIDE = (
    "icao24 callsign origin_country snapshot_ts event_time time_window flight_phase on_ground latitude longitude height "
    "x_ecef y_ecef z_ecef velocity mach vertical_rate true_track r_to_earth r_to_station station_id station_name "
    "station_lat station_lon station_h event_ts"
)
FACTS = (
    "event_ts icao24 station_id snapshot_time time_window flight_phase on_ground latitude longitude height x_ecef y_ecef "
    "z_ecef velocity mach vertical_rate true_track r_to_earth r_to_station"
)
FLIGHTS = (
    "event_ts icao24 callsign origin_country total_points first_seen last_seen tracked_sec max_height max_velocity "
    "max_mach avg_velocity min_r_to_station avg_r_to_station distance_km dominant_station"
)
MINUTES = (
    "event_ts time_window flight_phase points_in_window flights_in_window avg_height avg_velocity avg_mach "
    "avg_r_to_station"
)
DIM_STATION = "station_sk station_id name station_type lat lon h valid_from valid_to is_current"
SECOND = "TIMESTAMP '2024-06-01 01:00:00'"


def _rules(source: str, rules: dict[str, str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, (SELECT count(*) FROM {source} WHERE {broken}) AS violations{extra}"
        for name, broken in rules.items()
    )


def _repeated(source: str, key: str, name: str, extra: str = "") -> str:
    return (
        f"SELECT '{name}' AS rule, (SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {key} HAVING count(*) > 1))"
        f" AS violations{extra}"
    )


def _source(states: str, label: str) -> str:
    extra = f", '{label}' AS input"
    return " UNION ALL ".join(
        [
            _rules(states, {"states_icao24_null": "icao24 IS NULL", "states_velocity_negative": "velocity < 0"}, extra),
            _repeated(states, "icao24, snapshot_ts", "states_point_repeated", extra),
            _rules("stations", {"stations_id_null": "station_id IS NULL"}, extra),
        ]
    )


def _empty(source: str, where: str, name: str) -> str:
    return f"SELECT '{name}' AS rule, (SELECT CAST(count(*) = 0 AS BIGINT) FROM {source} WHERE {where}) AS violations"


def _guards() -> str:
    types = "type IN ('large_airport', 'medium_airport') AND "
    boxes = {"in_region": (50, 53), "nowhere": (-10, -9)}
    parts = []
    for label, (low, high) in boxes.items():
        parts.append(
            _empty(
                "airports",
                f"{types} latitude_deg BETWEEN {low} AND {high} AND longitude_deg BETWEEN 4 AND 11",
                f"stations_{label}",
            )
        )
        parts.append(
            _empty("states", f"latitude BETWEEN {low} AND {high} AND longitude BETWEEN 4 AND 11", f"points_{label}")
        )
    return " UNION ALL ".join(parts)


def _dimension_rules() -> str:
    flight, station = ", 'flight' AS dimension", ", 'station' AS dimension"
    return " UNION ALL ".join(
        [
            _rules(
                "dim_flight",
                {
                    "icao24_null": "icao24 IS NULL",
                    "icao24_too_long": "length(icao24) > 6",
                    "callsign_too_long": "length(callsign) > 16",
                    "origin_country_too_long": "length(origin_country) > 128",
                },
                flight,
            ),
            _repeated("dim_flight", "icao24", "icao24_repeated", flight),
            _rules(
                "dim_station",
                {
                    "station_sk_null": "false",
                    "station_id_null": "station_id IS NULL",
                    "station_id_too_long": "length(station_id) > 16",
                    "name_too_long": "length(name) > 255",
                    "station_type_too_long": "length(station_type) > 32",
                },
                station,
            ),
            _repeated("dim_station WHERE station_sk IS NOT NULL", "station_sk", "station_sk_repeated", station),
            _repeated("dim_station", "station_id, valid_from", "station_version_repeated", station),
        ]
    )


def _target() -> str:
    lost = "(SELECT count(*) FROM clean)"
    return " UNION ALL ".join(
        [
            f"SELECT 'points_count_changed' AS rule, abs({lost} - (SELECT count(*) FROM wide)) AS violations, 'stations' AS input",
            _rules("wide", {"points_station_null": "station_id IS NULL"}, ", 'stations' AS input"),
            f"SELECT 'points_count_changed' AS rule, {lost} AS violations, 'no stations' AS input",
            "SELECT 'points_station_null' AS rule, 0 AS violations, 'no stations' AS input",
        ]
    )


OBT = f"{FACTS} callsign origin_country station_name station_type station_lat station_lon station_h"
_UNEXPIRED = "snapshot_time + INTERVAL 1 YEAR > TIMESTAMP '2025-01-01 00:05:00'"

DIM_FLIGHT = "icao24 callsign origin_country last_ts updated_at"


def _newest_sighting(old: str, new: str) -> str:
    columns = ", ".join(DIM_FLIGHT.split())
    return f"""
        SELECT {columns} FROM (SELECT *, 0 AS load FROM {old} UNION ALL BY NAME SELECT *, 1 AS load FROM {new})
        QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY last_ts DESC, load) = 1"""


_SCD2_SQL = pick("dim_station", DIM_STATION)
_NEAREST = pick("wide", "icao24 snapshot_ts station_id r_to_station")

ORACLE = {
    "scan_states": pick("states", STATES),
    "scan_stations": pick("stations", STATIONS),
    "csv_to_parquet": pick("states", STATES),
    "csv_roundtrip": pick("stations", STATIONS),
    "dq_csv": " UNION ALL ".join(
        f"SELECT '{c}' AS rule, (SELECT count(*) FROM states WHERE {w}) AS violations"
        for c, w in (("velocity", "spi"), ("snapshot_ts", "spi"), ("squawk", "false"), ("latitude", "false"))
    ),
    "stations_from_airports": pick("stations", STATIONS, "ORDER BY station_id"),
    "parse_snapshots": pick("states", STATES),
    "dedup_snapshots": pick("first_arrivals", STATES),
    "dedup_states": pick("first_arrivals", f"{STATES} arrival"),
    "dq_payloads": """
        SELECT 'payload_unreadable' AS rule, count(*) AS violations FROM (SELECT DISTINCT (snapshot_ts - 1704067200) // 20 AS n FROM states) WHERE n % 7 = 3
        UNION ALL
        SELECT 'payload_time_missing', count(*) FROM (SELECT DISTINCT (snapshot_ts - 1704067200) // 20 AS n FROM states) WHERE n % 7 <> 3 AND n % 11 = 4
        UNION ALL
        SELECT 'payload_aircraft_repeated', 0""",
    "curated_roundtrip": (
        pick("wide", ["date='2024-01-02'", "points=count(*)", "total_r=sum(r_to_station)"])
        + " UNION ALL "
        + pick("wide", ["date='2024-01-01'", "points=count(*)", "total_r=sum(r_to_station)"])
    ),
    "publish_guard": pick(
        "states", ["date='2024-01-01'", "points=count(*)", "empty_refused=true", "missing_refused=true"]
    ),
    "fact_append": pick(
        "store",
        ["month=strftime(snapshot_time, '%Y%m')", "event_ts", "load_seq=CAST(load_seq AS BIGINT)", "facts=count(*)",
         "total_velocity=sum(velocity)"],
        "GROUP BY strftime(snapshot_time, '%Y%m'), event_ts, load_seq",
    ),
    "states_in_bbox": pick("states", STATES, "WHERE latitude BETWEEN 50.5 AND 52 AND longitude BETWEEN 5 AND 9"),
    "clean_points": pick("clean", "icao24 snapshot_ts latitude longitude velocity height vertical_rate"),
    "enrich_points": pick(
        "points",
        "icao24 snapshot_ts event_time time_window flight_phase height x_ecef y_ecef z_ecef r_to_earth mach",
    ),
    "ecef_points": pick("points", "icao24 snapshot_ts x_ecef y_ecef z_ecef r_to_earth prime_vertical=n"),
    "ecef_stations": pick("station_xyz", "station_id station_x station_y station_z"),
    "mach_points": pick(
        "air",
        ["icao24", "snapshot_ts", "temperature", "speed_of_sound=sqrt(1.4e0 * 287.05e0 * temperature)",
         "mach=velocity / sqrt(1.4e0 * 287.05e0 * temperature)"],
    ),
    "flight_phase": pick("points", "icao24 snapshot_ts flight_phase"),
    "minute_bucket": pick(
        "states", ["minute=(snapshot_ts // 60) * 60", "points=count(*)"], "GROUP BY (snapshot_ts // 60) * 60"
    ),
    "nearest_station": _NEAREST,
    "nearest_station_window": _NEAREST,
    "nearest_crowded": pick("crowd_best", ["icao24", "snapshot_ts", "station_id=b.station_id", "r_to_station=b.r"]),
    "point_station_distances": pick(
        "wide JOIN station_xyz USING (station_id)",
        ["icao24", "snapshot_ts", "station_id", "r_to_station",
         "station_distance=sqrt(pow(x_ecef - station_x, 2) + pow(y_ecef - station_y, 2) + pow(z_ecef - station_z, 2))"],
    ),
    "flight_points": pick("wide", WIDE),
    "dominant_station": pick("dominant", "icao24 dominant_station"),
    "flights_agg": pick("flights", FLIGHTS),
    "time_agg": pick("minutes", MINUTES, "ORDER BY time_window, flight_phase"),
    "top_flights_by_height": pick(
        "flights",
        "icao24 callsign origin_country max_height max_mach tracked_sec",
        "ORDER BY flights.max_height DESC, icao24, callsign NULLS FIRST, origin_country LIMIT 10",
    ),
    "phase_distribution": pick(
        "points",
        ["flight_phase", "points=count(*)", "pct=round(100 * count(*) / sum(count(*)) OVER (), 1)"],
        "GROUP BY flight_phase",
    ),
    "run_summary": pick(
        "flights",
        ["total_flights=count(icao24)", "total_points=CAST(sum(total_points) AS BIGINT)",
         "avg_max_mach=round(avg(max_mach), 3)", "global_max_height_m=round(max(max_height), 1)"],
    ),
    "poll_summary": pick(
        "first_arrivals",
        ["points=count(*)", "aircraft=count(DISTINCT icao24)", "snapshots=count(DISTINCT snapshot_ts)",
         "requests=(SELECT count(DISTINCT arrival) FROM arrivals)"],
    ),
    "map_positions": pick(
        "points",
        "icao24 callsign=trim(callsign) origin_country snapshot_ts latitude longitude height velocity true_track on_ground"
        " vertical_rate flight_phase",
        "QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY snapshot_ts DESC) = 1",
    ),
    "traffic_by_minute": pick(
        "points",
        ["time_window=make_timestamp(time_window * 1000000)", "points=count(*)", "aircraft=count(DISTINCT icao24)"],
        "GROUP BY points.time_window",
    ),
    "time_agg_merged": pick("minutes", MINUTES),
    "traffic_merged": pick(
        "points",
        ["time_window=make_timestamp(time_window * 1000000)", "points=count(*)", "aircraft=count(DISTINCT icao24)"],
        "GROUP BY points.time_window",
    ),
    "traffic_by_hour": pick(
        "points",
        ["time_window=make_timestamp(time_window // 3600 * 3600000000)", "points=count(*)", "aircraft=count(DISTINCT icao24)"],
        "GROUP BY points.time_window // 3600",
    ),
    "traffic_by_country": pick(
        "points", ["origin_country", "points=count(*)", "aircraft=count(DISTINCT icao24)"], "GROUP BY origin_country"
    ),
    "traffic_by_station": pick(
        "wide",
        ["station_id", "station_name", "points=count(*)", "aircraft=count(DISTINCT icao24)",
         "avg_r_to_station=avg(r_to_station)"],
        "GROUP BY station_id, station_name",
    ),
    "qc_ground_at_altitude": pick("points", "icao24 snapshot_ts height", "WHERE on_ground AND points.height >= 1000"),
    "dq_source": _source("states", "clean")
    + " UNION ALL "
    + _rules("stations", {"stations_geometry_null": "lat IS NULL OR lon IS NULL OR h IS NULL"}, ", 'clean' AS input")
    + " UNION ALL "
    + _source("faulty", "faulty"),
    "dq_duplicates": pick(
        "arrivals", ["icao24", "snapshot_ts", "copies=count(*)"], "GROUP BY icao24, snapshot_ts HAVING count(*) > 1"
    ),
    "dq_target": _target(),
    "dq_guards": _guards(),
    "dq_dimensions": _dimension_rules(),
    "dim_flight_input": pick("last_seen", "icao24 callsign origin_country last_ts"),
    "dim_station_input": pick("stations", STATIONS),
    "scd1_flight": pick("dim_flight", DIM_FLIGHT),
    "scd1_whole_load": f"""
        SELECT {', '.join(DIM_FLIGHT.split())} FROM all_flights
        UNION ALL
        SELECT {', '.join(DIM_FLIGHT.split())} FROM old_flights o WHERE o.icao24 NOT IN (SELECT icao24 FROM all_flights)""",
    "scd1_newest": _newest_sighting("old_flights", "loaded_flights"),
    "station_numbers": """
        SELECT count(*) AS opened, count(*) AS numbers, 1 AS first_step, count(*) AS last_step FROM opened""",
    "scd2_station": _SCD2_SQL,
    "new_stations": pick(
        "stations s", "station_id name", "WHERE NOT EXISTS (SELECT 1 FROM old_open o WHERE o.station_id = s.station_id)"
    ),
    "vanished_stations": pick(
        "old_open o", "station_id name", "WHERE NOT EXISTS (SELECT 1 FROM stations s WHERE o.station_id = s.station_id)"
    ),
    "dim_station_current": f"{_SCD2_SQL} WHERE is_current",
    "fact_projection": pick("facts", FACTS),
    "fact_latest": pick("newest_facts", FACTS),
    "flights_agg_latest": pick("newest_flights", FLIGHTS),
    "time_agg_latest": pick("newest_minutes", MINUTES),
    "retention": pick(
        "store",
        ["icao24", "snapshot_time", "load_seq=CAST(load_seq AS BIGINT)", "velocity"],
        f"WHERE {_UNEXPIRED}",
    ),
    "obt_view": pick("obt", OBT),
    "obt_view_unexpired": pick("obt", OBT, f"WHERE {_UNEXPIRED}"),
    "obt_view_range": pick(
        "obt", OBT, "WHERE snapshot_time >= TIMESTAMP '2024-01-01 00:03:00' AND snapshot_time < TIMESTAMP '2024-01-01 00:08:00'"
    ),
    "fact_latest_unexpired": pick("newest_facts", FACTS, f"WHERE {_UNEXPIRED}"),
    "daily_run": pick("wide", WIDE),
    "daily_run_tables": """
        SELECT 'facts' AS table_name, count(*) AS n FROM wide
        UNION ALL SELECT 'flights', count(*) FROM flights
        UNION ALL SELECT 'minutes', count(*) FROM minutes
        UNION ALL SELECT 'dim_flight', count(DISTINCT icao24) FROM wide
        UNION ALL SELECT 'dim_station', count(*) FROM dim_station
        UNION ALL SELECT 'open_stations', count(*) FROM dim_station WHERE is_current""",
    "stream_ingest": pick("states", STATES),
    "stream_refused": """
        SELECT CASE WHEN n % 7 = 3 THEN 'payload_unreadable' ELSE 'payload_time_missing' END AS rule, count(*) AS rows
        FROM (SELECT DISTINCT (snapshot_ts - 1704067200) // 20 AS n FROM states) WHERE n % 7 = 3 OR n % 11 = 4 GROUP BY ALL""",
    "stream_time_agg": pick("minutes", MINUTES.replace("event_ts ", "").replace(" avg_r_to_station", "")),
    "stream_nearest": _NEAREST,
    "stream_upsert": _newest_sighting("old_flights", "all_flights"),
}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in ORACLE.items()}
