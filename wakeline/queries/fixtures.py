"""The given tables seen as vessel data.

Each view is one list of SQL expressions that Spark and DuckDB both understand, so the query and
its check read the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.session import prepare

AS_OF = "2024-01-31 00:00:00"
SCENE_AT = "2024-01-15 12:00:00"
SCENE_BOX = (8.0, 54.0, 30.0, 58.2)
SCENE_SIZE = 64

_PREFIX = ("CASE WHEN {k} % 17 = 0 THEN '273' ELSE CAST(201 + ({k} * 7) % 560 AS STRING) END"
           " || lpad(CAST({k} AS STRING), 6, '0')")
_MMSI = _PREFIX.format(k="user_id")
_BASE_LAT = "54e0 + (({k} * 37) % 400) / 1e2"
_BASE_LON = "8e0 + (({k} * 131) % 220) / 1e1"
_TWO = "lpad(CAST({x} AS STRING), 2, '0')"

VIEWS: dict[str, tuple[str, list[str], str | None]] = {
    "v_contacts": ("events", [
        "event_id", "event_id AS row_id", "CAST(ts AS TIMESTAMP) AS observed_at", "user_id",
        _MMSI + " AS mmsi",
        "CASE WHEN user_id % 3 = 0 THEN CAST(9000000 + user_id AS STRING) ELSE '' END AS imo",
        "CASE WHEN user_id % 5 = 0 THEN 'C' || CAST(user_id AS STRING) ELSE '' END AS callsign",
        "CASE WHEN user_id % 7 = 0 THEN 'ATLAS' WHEN user_id % 2 = 0 THEN ' Vessel   ' || CAST(user_id AS STRING) || ' '"
        " ELSE '' END AS name",
        _BASE_LAT.format(k="user_id") + " + (event_id % 40) * 2e-3 AS latitude",
        _BASE_LON.format(k="user_id") + " AS longitude",
        "round(value % 3e1, 2) AS sog", "round((value * 7e0) % 36e1, 2) AS cog", "event_id % 520 AS true_heading",
        "70 + user_id % 20 AS ship_type",
        "CASE WHEN user_id % 11 = 0 THEN 'oil  tanker' ELSE '' END AS ship_type_text",
        "CASE user_id % 6 WHEN 0 THEN 'RU LED' WHEN 1 THEN 'PLGDN' WHEN 2 THEN 'FOR ORDERS'"
        " WHEN 3 THEN 'St. Petersburg via Kiel' WHEN 4 THEN 'DEHAM' ELSE '' END AS destination",
        "CASE WHEN user_id % 97 = 5 THEN 'RU ULU' WHEN user_id % 89 = 3 THEN 'Gdynia' ELSE '' END AS last_port",
        "CASE user_id % 8 WHEN 0 THEN 'Nation_' || CAST(user_id % 25 AS STRING)"
        " WHEN 1 THEN 'n' || lpad(CAST(user_id % 25 AS STRING), 2, '0') WHEN 2 THEN 'Elsewhere' ELSE '' END AS flag",
        "CASE event_type WHEN 'click' THEN 'fintraffic' WHEN 'view' THEN 'barentswatch'"
        " WHEN 'purchase' THEN 'ais_dk_historical' WHEN 'signup' THEN 'global_fishing_watch' ELSE 'aisstream' END"
        " AS provider",
        "event_id % 9 <> 0 AS timestamp_valid", "length(props) + 40 AS row_bytes", "value"], None),
    # Destinations that change over time, for the route states.
    "v_voyages": ("events", [
        "event_id", "CAST(ts AS TIMESTAMP) AS observed_at", "'mmsi:' || " + _MMSI + " AS identity_key",
        "CASE event_id % 7 WHEN 0 THEN 'RU LED' WHEN 1 THEN 'DEHAM' WHEN 2 THEN 'Ust-Luga' WHEN 3 THEN 'SEGOT' END"
        " AS destination",
        "event_id % 7 IN (0, 2) AS declared", "event_id % 23 = 0 AS port_seen"], None),
    "v_watchlist": ("customer", [
        "c_custkey AS line_no", "CASE WHEN c_custkey % 50 = 0 THEN 'EXAMPLE ' ELSE '' END || c_name AS name",
        "CASE WHEN c_custkey % 3 = 0 THEN CAST(9000000 + c_custkey % 1000 AS STRING) ELSE '' END AS imo",
        "CASE WHEN c_custkey % 4 = 0 THEN " + _PREFIX.format(k="(c_custkey % 900)") + " ELSE '' END AS mmsi",
        "CASE WHEN c_custkey % 10 = 0 THEN 'c' || CAST(c_custkey AS STRING) ELSE '' END AS callsign",
        "c_mktsegment = 'BUILDING' AS track_sanctions", "c_mktsegment = 'MACHINERY' AS track_shadowfleet",
        "c_mktsegment = 'FURNITURE' AS track_falseflag", "c_mktsegment = 'HOUSEHOLD' AS track_behavior",
        "CASE WHEN c_custkey % 46 = 0 THEN 'No' ELSE 'true' END AS active",
        "CASE WHEN c_custkey % 60 = 7 THEN 'dummy row' ELSE '' END AS notes",
        "CASE WHEN c_custkey % 3 = 1 THEN 'EU;OFAC' ELSE 'manual' END AS source_list"], None),
    "v_infra": ("supplier", [
        "CAST(s_suppkey AS STRING) AS feature_id",
        "CASE s_suppkey % 3 WHEN 0 THEN 'power_cable' WHEN 1 THEN 'pipeline' ELSE 'telecommunication_cable' END"
        " AS infrastructure_type",
        _BASE_LON.format(k="s_suppkey") + " - 5e-2 AS a_lon", _BASE_LAT.format(k="s_suppkey") + " AS a_lat",
        _BASE_LON.format(k="s_suppkey") + " + 5e-2 AS b_lon", _BASE_LAT.format(k="s_suppkey") + " + 1e-2 AS b_lat",
        "s_name"], None),
    "v_flags": ("nation", [
        "n_nationkey AS line_no", "n_name AS state_name", "'N' || lpad(CAST(n_nationkey AS STRING), 2, '0') AS iso_code",
        "CAST(201 + n_nationkey * 7 AS STRING) || '; ' || CAST(404 + n_nationkey * 7 AS STRING)"
        " || CASE WHEN n_nationkey = 3 THEN ', 351' ELSE '' END AS mmsi_mid_prefixes",
        "CASE n_nationkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'b' ELSE 'C' END AS risk_category",
        "CASE n_nationkey % 4 WHEN 0 THEN 'historical_abuse' WHEN 1 THEN 'open_registry_watch'"
        " WHEN 2 THEN 'fraud_notice' ELSE 'other' END AS registry_status",
        "CASE WHEN n_nationkey % 6 = 5 THEN 'no' ELSE 'true' END AS active"], None),
    "v_ports": ("nation", [
        "CASE n_nationkey WHEN 0 THEN 'RU LED' WHEN 1 THEN 'RU ULU' WHEN 2 THEN 'RU PRI'"
        " ELSE 'ZZ ' || lpad(CAST(n_nationkey AS STRING), 3, '0') END AS unlocode",
        "CASE n_nationkey WHEN 0 THEN 'St. Petersburg' WHEN 1 THEN 'Ust-Luga' WHEN 2 THEN 'Primorsk'"
        " ELSE n_name END AS port_name",
        "CASE n_nationkey WHEN 0 THEN 'RULED;RU LED;LED;ST PETERSBURG' WHEN 1 THEN 'RUULU, UST LUGA'"
        " WHEN 2 THEN 'RUPRI|KOIVISTO' ELSE '' END AS aliases"], None),
    "v_archive": ("events", [
        "event_id", "CASE WHEN event_id % 1201 = 0 THEN 'Timestamp' WHEN event_id % 307 = 0 THEN '2024-01-01'"
        " ELSE " + _TWO.format(x="day(ts)") + " || '/' || " + _TWO.format(x="month(ts)")
        + " || '/' || CAST(year(ts) AS STRING) || ' ' || " + _TWO.format(x="hour(ts) - hour(ts) % 6")
        + " || ':00:00' END AS timestamp",
        "CASE WHEN event_id % 41 = 0 THEN 'Base Station' WHEN event_id % 2 = 0 THEN 'Class A' ELSE 'class  b' END"
        " AS type_of_mobile",
        "CASE WHEN event_id % 211 = 0 THEN '12345678' ELSE " + _MMSI + " END AS mmsi",
        "CASE WHEN event_id % 173 = 0 THEN '0' ELSE CAST(" + _BASE_LAT.format(k="user_id")
        + " + (event_id % 3) * 2e-3 AS STRING) END AS latitude",
        "CASE WHEN event_id % 173 = 0 THEN '0.0' ELSE CAST(" + _BASE_LON.format(k="user_id") + " AS STRING) END AS longitude",
        "'Unknown value' AS navigational_status", "'' AS rot", "CAST(round(value % 11e1, 1) AS STRING) AS sog",
        "CAST(round(value % 4e2, 1) AS STRING) AS cog", "CAST(event_id % 520 AS STRING) AS heading",
        "CASE WHEN user_id % 3 = 0 THEN CAST(9000000 + user_id AS STRING) ELSE 'Unknown' END AS imo",
        "CASE WHEN event_id % 4 = 0 THEN 'C' || CAST(user_id AS STRING) ELSE 'Unknown' END AS callsign",
        "CASE WHEN event_id % 5 = 0 THEN 'SHIP ' || CAST(user_id AS STRING) ELSE '' END AS name",
        "CASE user_id % 3 WHEN 0 THEN 'Tanker' WHEN 1 THEN 'Cargo' ELSE 'Undefined' END AS ship_type",
        "'N/A' AS cargo_type", "CASE WHEN event_id % 6 = 0 THEN '12' ELSE '' END AS width",
        "CAST(50 + user_id AS STRING) AS length", "'GPS' AS position_fixing_device", "'' AS draught",
        "CASE WHEN event_id % 3 = 0 THEN 'GOTHENBURG' ELSE 'Unknown' END AS destination", "'' AS eta",
        "'AIS' AS data_source_type", "'' AS size_a", "'' AS size_b", "'' AS size_c", "'1' AS size_d",
        "CASE WHEN event_id % 501 = 0 THEN 25 ELSE 26 END AS column_count"], None),
    "v_grid": ("lineitem", [
        "'region_' || l_returnflag AS region_id", "l_linestatus = 'F' AS ais_matched",
        "CASE WHEN l_orderkey % 499 = 0 THEN NULL ELSE CAST(l_shipdate + l_linenumber * INTERVAL 1 HOUR AS TIMESTAMP) END"
        " AS observed_at",
        "CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE 'v' || CAST(l_suppkey * 10 + l_partkey % 10 AS STRING) END"
        " AS vessel_id",
        "CASE WHEN l_orderkey % 997 = 0 THEN 95e0 ELSE 54e0 + (l_partkey % 4) / 1e2 END AS latitude",
        "8e0 + (l_suppkey % 20) / 1e1 AS longitude",
        "CASE WHEN l_suppkey % 3 = 0 THEN CAST(9000000 + l_suppkey AS STRING) ELSE '' END AS imo",
        "CASE WHEN l_suppkey % 2 = 0 THEN " + _PREFIX.format(k="l_suppkey") + " ELSE '' END AS mmsi",
        "l_discount * 1e2 AS hours", "l_linenumber AS detections"], None),
    "v_pixels": ("events", [
        "CAST(floor(event_id / 4096e0) AS INT) AS scene_id", "CAST(floor((event_id % 4096) / 64e0) AS INT) AS px_row",
        "CAST(event_id % 64 AS INT) AS px_col",
        "CASE WHEN floor((event_id % 4096) / 64e0) % 12 = 6 AND event_id % 64 % 12 IN (5, 6)"
        " THEN 4e-1 + value / 1e3 ELSE 1e-2 + value / 1e4 END AS vv",
        "CASE WHEN floor((event_id % 4096) / 64e0) % 24 = 6 AND event_id % 64 % 12 = 6"
        " THEN 3e-1 + value / 1e3 ELSE 5e-3 + value / 2e4 END AS vh",
        "CASE WHEN event_id % 509 = 0 THEN 2e-1 ELSE 1e0 END AS mask", "event_id % 509 <> 0 AS valid"], None),
    "v_detections": ("part", [
        "'D' || lpad(CAST(p_partkey AS STRING), 9, '0') AS detection_id",
        _BASE_LON.format(k="(p_partkey % 150)") + " + (p_size - 25) * 1e-3 AS longitude",
        _BASE_LAT.format(k="(p_partkey % 150)") + " + (p_partkey % 40) * 2e-3 AS latitude",
        "p_size * 4e0 AS span_x_m", "p_size * 3e0 AS span_y_m"], None),
    "v_members": ("part", [
        "CAST(floor(p_partkey / 2e0) AS BIGINT) AS object_id",
        "'D' || lpad(CAST(p_partkey AS STRING), 9, '0') AS detection_id", "p_partkey % 2 = 0 AS is_representative",
        "12e0 + floor(p_partkey / 2e0) * 1e-4 + (p_partkey % 2) * p_size * 1e-4 AS longitude",
        "54e0 + (p_partkey % 2) * 1e-5 * (p_size % 7) AS latitude",
        "CASE WHEN p_size % 11 = 0 THEN '2' ELSE '1' END || lpad(CAST(CAST(floor(p_partkey / 2e0) AS BIGINT) AS STRING),"
        " 8, '0') AS mmsi",
        "12e0 + floor(p_partkey / 2e0) * 1e-4 + (p_size % 5) * 2e-4 AS projected_longitude",
        "54e0 + (p_size % 3) * 1e-4 AS projected_latitude", "8e1 + p_size AS effective_cog",
        "1e2 + p_size * 3e0 AS length_m", "p_size % 13 <> 0 AS within_dynamic_radius",
        "1 + p_size % 3 AS profile_count", "p_size % 2 = 0 AS vh_corroborated", "p_size * 5 AS gap_seconds",
        "CASE p_size % 4 WHEN 0 THEN 'LOW' WHEN 1 THEN 'MEDIUM' ELSE 'HIGH' END AS projection_quality",
        "p_size % 17 <> 0 AS coverage_ok", "p_size % 19 <> 0 AS bins_complete",
        "CASE p_size % 3 WHEN 0 THEN 'MATCHED' WHEN 1 THEN 'POSSIBLE_MATCH' ELSE 'AMBIGUOUS' END AS match_state",
        "p_size * 45e0 AS distance_m", "p_size * 6e0 AS span_m"], None),
    "v_history": ("events", [
        "event_id", "CAST(user_id AS STRING) || '|' || CAST(event_id % 40 AS STRING) AS history_key",
        "CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 211 = 0 THEN CAST(ts + INTERVAL 60 DAY AS TIMESTAMP)"
        " ELSE CAST(ts AS TIMESTAMP) END AS seen_at",
        "CASE WHEN user_id % 13 = 0 THEN 'unknown' ELSE " + _MMSI + " END AS mmsi",
        "CASE WHEN user_id % 3 = 0 THEN CAST(9000000 + user_id AS STRING) ELSE '' END AS imo", "'' AS callsign",
        "'Ship  ' || CAST(user_id AS STRING) AS name", "user_id % 4 = 0 AS is_priority_voi",
        _BASE_LAT.format(k="user_id") + " + (event_id % 40) * 2e-3 AS latitude",
        _BASE_LON.format(k="user_id") + " AS longitude", "length(props) + 40 + user_id % 50 AS row_bytes"], None),
}

_TYPES = {"STRING": "VARCHAR"}
_ROUND = re.compile(r"\bround\((.+?), (\d)\)")


def spark_columns(name: str) -> list[str]:
    """The view's expressions for Spark. ``round(x, n)`` of a double rounds what ``x * 10^n`` is as a double in DuckDB,
    and the shortest decimal of ``x`` in Spark; the two differ where ``x`` lies an ulp below a half."""
    return [_ROUND.sub(r"(round((\1) * 1e\2) / 1e\2)", c) for c in VIEWS[name][1]]


def view_sql(name: str) -> str:
    """The view as DuckDB SQL."""
    table, columns, where = VIEWS[name]
    return f"SELECT {', '.join(columns)} FROM {table}" + (f" WHERE {where}" if where else "")


def with_views(sql: str) -> str:
    """The check's SQL with the views it names put in front as common table expressions."""
    used = [n for n in VIEWS if n in sql]
    if not used:
        return sql
    body = sql.strip()
    ctes = ", ".join(f"{n} AS ({view_sql(n)})" for n in used)
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes}, {body[len('WITH RECURSIVE '):]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[len('WITH '):]}"
    return f"WITH {ctes} {body}"


class Tables:
    """The given tables and the views on them, read lazily and column-pruned by Spark."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        table, _, where = VIEWS["v_" + name]
        rows = self.table(table)
        return (rows.where(where) if where else rows).selectExpr(*spark_columns("v_" + name))

    def __getattr__(self, name: str) -> DataFrame:
        if "v_" + name in VIEWS:
            return self.view(name)
        raise AttributeError(name)

    @property
    def as_of(self):
        return F.lit(AS_OF).cast("timestamp")

    @property
    def scene_at(self):
        return F.lit(SCENE_AT).cast("timestamp")
