"""Daily archive rows to typed records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.records import clean_motion
from wakeline.functions.text import norm_digits, normalize_unknown, parse_float, present
from wakeline.functions.times import parse_archive_dt
from wakeline.operators.filters import archive_reject_reason, valid_imo


def typed_records(rows: DataFrame, seq: str, column_count=None) -> DataFrame:
    """Valid rows as typed records; rejects are counted by ``filters.reject_counts``."""
    good = rows.where(archive_reject_reason(column_count).isNull())
    label = normalize_unknown("ship_type")
    tanker = F.coalesce(F.lower(label).contains("tanker"), F.lit(False))
    return good.select(
        F.col(seq), norm_digits("mmsi").alias("mmsi"), valid_imo("imo").alias("imo"),
        normalize_unknown("callsign").alias("callsign"), normalize_unknown("name").alias("name"),
        parse_archive_dt("timestamp").alias("observed_at"),
        F.round(parse_float("latitude"), 6).alias("latitude"), F.round(parse_float("longitude"), 6).alias("longitude"),
        normalize_unknown("navigational_status").alias("navigational_status"),
        clean_motion("sog", "sog").alias("sog"), clean_motion("cog", "cog").alias("cog"),
        clean_motion("heading", "heading").alias("true_heading"),
        F.when(tanker, "80").otherwise(label).alias("ship_type"), label.alias("ship_type_label"),
        tanker.alias("is_tanker_context_candidate"), normalize_unknown("cargo_type").alias("cargo_type"),
        parse_float("width").alias("width_m"), parse_float("length").alias("length_m"),
        parse_float("draught").alias("draught_m"), normalize_unknown("destination").alias("destination"),
        normalize_unknown("eta").alias("eta_raw"), present("type_of_mobile").alias("target_type"),
        F.coalesce(normalize_unknown("data_source_type"), F.lit("AIS")).alias("data_source_type"))
