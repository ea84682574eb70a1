"""Feed dialects to the common contact: one projection per feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.functions import identity
from wakeline.functions.records import clean_motion
from wakeline.functions.text import collapse, norm_digits, parse_float, present
from wakeline.functions.times import normalize_timestamp, parse_dt
from wakeline.operators.filters import valid_imo, valid_mmsi
from wakeline.sources.readers import column_or_null

CONTACT = ("mmsi", "imo", "callsign", "name", "latitude", "longitude", "destination", "ship_type",
           "navigational_status", "sog", "cog", "true_heading", "provider", "observed_at",
           "position_timestamp_valid", "position_timestamp_basis")

# --- fixed values: column names tried per feed, first non-empty wins ---------------
REGIONAL = {
    "fintraffic": {
        "mmsi": ("mmsi", "MMSI"), "imo": ("imo", "imoNumber", "IMO"),
        "callsign": ("callSign", "callsign", "CallSign"), "name": ("name", "shipName", "ShipName"),
        "latitude": ("lat", "latitude", "Latitude"), "longitude": ("lon", "longitude", "Longitude"),
        "destination": ("destination", "Destination"), "ship_type": ("type", "shipType", "ShipType"),
        "navigational_status": ("navStat", "navigationalStatus", "NavigationalStatus"),
        "sog": ("sog", "speedOverGround", "Sog"), "cog": ("cog", "courseOverGround", "Cog"),
        "true_heading": ("heading", "trueHeading", "TrueHeading"),
        "at": ("timestamp", "time", "timestampExternal", "msgtime")},
    "barentswatch": {
        "mmsi": ("mmsi", "MMSI"), "imo": ("imoNumber", "imo", "IMO"),
        "callsign": ("callSign", "callsign", "CallSign"), "name": ("name", "shipName", "ShipName"),
        "latitude": ("latitude", "lat", "Latitude"), "longitude": ("longitude", "lon", "Longitude"),
        "destination": ("destination", "Destination"), "ship_type": ("shipType", "type", "ShipType"),
        "navigational_status": ("navigationalStatus", "navStat", "NavigationalStatus"),
        "sog": ("speedOverGround", "sog", "Sog"), "cog": ("courseOverGround", "cog", "Cog"),
        "true_heading": ("trueHeading", "heading", "TrueHeading"),
        "at": ("msgtime", "timestamp", "time")},
}


def regional_contact(records: DataFrame, provider: str, fetched_at: Column, as_of: Column, record: str = "record"
                     ) -> DataFrame:
    """Regional feed records (JSON text, plain or GeoJSON) to contacts; rows without MMSI are dropped."""
    names = REGIONAL[provider]
    props = F.coalesce(F.get_json_object(record, "$.properties"), F.col(record))

    def pick(field: str) -> Column:
        return F.coalesce(*[present(F.get_json_object(props, f"$.{n}")) for n in names[field]])

    place = lambda i, field: F.coalesce(
        present(F.get_json_object(record, f"$.geometry.coordinates[{i}]")), pick(field)).try_cast("double")
    at, valid, basis = normalize_timestamp(pick("at"), fetched_at, as_of)
    out = {
        "mmsi": norm_digits(pick("mmsi")), "imo": pick("imo"), "callsign": pick("callsign"), "name": pick("name"),
        "latitude": place(1, "latitude"), "longitude": place(0, "longitude"), "destination": pick("destination"),
        "ship_type": pick("ship_type"), "navigational_status": pick("navigational_status"),
        "sog": clean_motion(pick("sog"), "sog"), "cog": clean_motion(pick("cog"), "cog"),
        "true_heading": clean_motion(pick("true_heading"), "heading"), "provider": F.lit(provider),
        "observed_at": at, "position_timestamp_valid": valid, "position_timestamp_basis": basis,
    }
    carried = [c for c in records.columns if c != record]
    return records.select(*carried, *[c.alias(n) for n, c in out.items()]).where("mmsi IS NOT NULL")


def archive_contact(records: DataFrame) -> DataFrame:
    """Typed daily-archive records to contacts."""
    return records.select(
        "mmsi", "imo", "callsign", "name", "latitude", "longitude", "destination", "ship_type", "navigational_status",
        "sog", "cog", "true_heading", F.lit("ais_dk_historical").alias("provider"), "observed_at",
        F.lit(True).alias("position_timestamp_valid"),
        F.lit("source_basestation_timestamp_utc_assumption").alias("position_timestamp_basis"))


def _finite(rows: DataFrame, name: str) -> Column:
    """``parse_float`` of a column; a column of doubles is not turned into text and back."""
    return F.when(F.abs(name) < float("inf"), F.col(name)) if rows.schema[name].dataType == T.DoubleType() else parse_float(name)


def grid_contact(rows: DataFrame) -> DataFrame:
    """Gridded presence rows to position records; rows without identity, time or place are dropped."""
    # What rows are dropped by stands in a generator: a filter is not pushed below it, where it would parse a second time.
    known = F.struct(
        identity.id_grid("mmsi", "imo", "vesselId").alias("identity_key"), _finite(rows, "lat").alias("latitude"), _finite(rows, "lon").alias("longitude"),
        F.date_trunc("second", parse_dt(F.coalesce(present("entryTimestamp"), present("date")))).alias("observed_at"))
    kept = rows.select("*", F.explode(F.array(known)).alias("_k")).where(
        "_k.identity_key IS NOT NULL AND _k.observed_at IS NOT NULL AND _k.latitude BETWEEN -90 AND 90 AND _k.longitude BETWEEN -180 AND 180")
    return kept.select(
        F.lit("global_fishing_watch").alias("provider"), "_k.identity_key", present("vesselId").alias("vessel_id"),
        valid_imo("imo").alias("imo"), valid_mmsi("mmsi").alias("mmsi"), collapse("callsign").alias("callsign"),
        collapse("shipName").alias("name"), "_k.latitude", "_k.longitude", "_k.observed_at",
        _finite(rows, "hours").alias("presence_hours"), F.lit(False).alias("position_is_exact"),
        F.lit(True).alias("timestamp_valid"), column_or_null(rows, "source_dataset"))


def position_record(contacts: DataFrame) -> DataFrame:
    """Contacts to position-history records; rows without identity, time or place are dropped."""
    out = contacts.select(
        "provider", identity.id_common().alias("identity_key"), norm_digits("mmsi").alias("mmsi"),
        norm_digits("imo").alias("imo"), collapse("callsign").alias("callsign"), collapse("name").alias("name"),
        parse_float("latitude").alias("latitude"), parse_float("longitude").alias("longitude"),
        F.date_trunc("second", "observed_at").alias("observed_at"),
        F.coalesce("position_timestamp_valid", F.lit(True)).alias("timestamp_valid"),
        F.coalesce(collapse("position_timestamp_basis"), F.lit("source_or_snapshot_timestamp")).alias("timestamp_basis"),
        (F.col("provider") != "global_fishing_watch").alias("position_is_exact"), "sog", "cog", "true_heading",
        collapse("destination").alias("destination"), "ship_type")
    return out.where("identity_key IS NOT NULL AND observed_at IS NOT NULL AND latitude BETWEEN -90 AND 90"
                     " AND longitude BETWEEN -180 AND 180")


def union_feeds(*feeds: DataFrame) -> DataFrame:
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed, allowMissingColumns=True)
    return out
