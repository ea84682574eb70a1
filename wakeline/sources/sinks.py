"""Writers. Every sink is one distributed write; small status rows are written beside it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions import geo
from wakeline.operators.history import assign_parts, shard_manifest


def point_geometry(lon: Column, lat: Column) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))


def line_geometry(*points: Column) -> Column:
    return F.struct(F.lit("LineString").alias("type"), F.array(*points).alias("coordinates"))


def feature_text(geometry: Column, properties: Sequence[str], feature_id: Column | None = None) -> Column:
    """One GeoJSON feature as text."""
    parts = [F.lit("Feature").alias("type")]
    if feature_id is not None:
        parts.append(feature_id.alias("id"))
    return F.to_json(F.struct(*parts, geometry.alias("geometry"), F.struct(*properties).alias("properties")))


def layer_features(items: DataFrame, properties: Sequence[str], layers: Sequence[str]) -> DataFrame:
    """(layer, value): each positioned item once per category."""
    placed = items.where("latitude IS NOT NULL AND longitude IS NOT NULL")
    exploded = placed.withColumn("layer", F.explode("categories")).where(F.col("layer").isin(*layers))
    text = feature_text(point_geometry(F.col("longitude"), F.col("latitude")), [*properties, "layer"])
    return exploded.select("layer", text.alias("value"))


def write_layers(items: DataFrame, path: str, properties: Sequence[str], layers: Sequence[str]) -> None:
    layer_features(items, properties, layers).write.partitionBy("layer").mode("overwrite").text(path)


def track_features(contacts: DataFrame, key: str, at: str) -> DataFrame:
    """Latest and previous points, and a connector line when they differ.

    Input: one row per vessel with ``latest_position`` and ``previous_position`` structs.
    """
    lat, prev = F.col("latest_position"), F.col("previous_position")
    rows = F.array_compact(F.array(
        F.when(lat.isNotNull(), F.struct(F.lit("latest_historical_position").alias("role"), F.to_json(point_geometry(
            lat["longitude"], lat["latitude"])).alias("geometry"), lat[at].alias("at"),
            F.lit(None).cast("double").alias("distance_nm"))),
        F.when(prev.isNotNull(), F.struct(F.lit("previous_historical_position").alias("role"), F.to_json(point_geometry(
            prev["longitude"], prev["latitude"])).alias("geometry"), prev[at].alias("at"),
            F.lit(None).cast("double").alias("distance_nm"))),
        F.when(prev.isNotNull() & ((lat["latitude"] != prev["latitude"]) | (lat["longitude"] != prev["longitude"])),
               F.struct(F.lit("historical_two_position_connector").alias("role"), F.to_json(line_geometry(
                   F.array(prev["longitude"], prev["latitude"]), F.array(lat["longitude"], lat["latitude"]))
                   ).alias("geometry"), lat[at].alias("at"), F.round(geo.haversine_nm(
                       prev["longitude"], prev["latitude"], lat["longitude"], lat["latitude"]), 3
                       ).alias("distance_nm")))))
    return contacts.select(key, F.explode(rows).alias("f")).select(key, "f.*")


def connector_features(correlated: DataFrame) -> DataFrame:
    """Radar point, context point and connector line of each time-aligned record."""
    from wakeline.functions.records import short_sha1

    aligned = F.col("ais_context_id").isNotNull()
    sar_xy = F.array("longitude", "latitude")
    ais_xy = F.array("ais_longitude", "ais_latitude")
    point = lambda xy: F.to_json(F.struct(F.lit("Point").alias("type"), xy.alias("coordinates")))
    rows = F.array_compact(F.array(
        F.struct(F.lit("sar_detection").alias("role"), F.col("id").alias("fid"), point(sar_xy).alias("geometry")),
        F.when(aligned, F.struct(F.lit("historical_ais_context").alias("role"), short_sha1(
            "aismap_", F.col("id"), F.col("ais_context_id")).alias("fid"), point(ais_xy).alias("geometry"))),
        F.when(aligned, F.struct(F.lit("sar_ais_connector").alias("role"), short_sha1(
            "sarcorr_", F.col("id"), F.col("ais_context_id")).alias("fid"), F.to_json(line_geometry(sar_xy, ais_xy)
                                                                                   ).alias("geometry")))))
    return correlated.select(F.explode(rows).alias("f"), "correlation_status", "watchlist_match", "ais_matched"
                             ).select("f.*", "correlation_status", "watchlist_match", "ais_matched")


def write_shards(rows: DataFrame, path: str, at: str, key: str, size: Column, max_bytes: int) -> DataFrame:
    """Day and part partitioned JSON Lines, plus the manifest, which is returned.

    Each part is written by one task in (time, key) order: parts are bounded by ``max_bytes``, and as full as the
    day's widest row allows, as every part is a file.
    """
    parts = assign_parts(rows, at, key, size, max_bytes, close=True)
    (parts.repartition("date_utc", "part").sortWithinPartitions("date_utc", "part", at, key).drop("line_bytes")
     .write.partitionBy("date_utc", "part").mode("overwrite").json(path))
    manifest = shard_manifest(parts, at)
    manifest.write.mode("overwrite").json(path.rstrip("/") + "_manifest")
    return manifest


def csv_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns only; nested values become JSON text, missing columns are empty."""
    kinds = dict(df.dtypes)
    picked = []
    for name in columns:
        if name not in kinds:
            picked.append(F.lit(None).cast("string").alias(name))
        elif kinds[name].startswith(("array", "map", "struct")):
            picked.append(F.to_json(name).alias(name))
        else:
            picked.append(F.col(name))
    return df.select(*picked)


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    csv_columns(df, columns).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_envelope(rows: DataFrame, meta: DataFrame, path: str) -> None:
    """Rows and their one-row metadata beside each other."""
    rows.write.mode("overwrite").json(path.rstrip("/") + "/rows")
    meta.write.mode("overwrite").json(path.rstrip("/") + "/meta")


def product_bytes(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*"))) + 1), F.lit(
        0)).alias("bytes"))


def write_if_small(rows: DataFrame, path: str, max_bytes: int | None = None) -> int:
    """Replaces the product; with a limit only when it stays within it, else the last good one remains.

    The product is written beside the old one, measured there, and moved into place, so a job that dies while
    writing leaves the old one. One that dies between the two moves leaves it as ``-last``.
    """
    at = rows.sparkSession._jvm.org.apache.hadoop.fs.Path
    home = path.rstrip("/")
    place, beside, last = at(home), at(home + "-next"), at(home + "-last")
    rows.write.mode("overwrite").json(home + "-next")
    store = place.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration())
    size = store.getContentSummary(beside).getLength()
    if max_bytes is not None and size > max_bytes:
        store.delete(beside, True)
        raise ValueError(f"product has {size} bytes, limit is {max_bytes}; previous product kept")
    if store.exists(place):
        store.delete(last, True)
        if not store.rename(place, last):
            raise OSError(f"{path} could not be moved aside")
    if not store.rename(beside, place):
        raise OSError(f"the new product could not be moved to {path}")
    store.delete(last, True)
    return size


def append_events(events: DataFrame, path: str) -> None:
    """Appends events whose id is not in the log yet."""
    from wakeline.operators.route import new_events
    from wakeline.sources.readers import _exists

    spark = events.sparkSession
    if _exists(spark, path):
        events = new_events(events, spark.read.parquet(path))
    else:
        events = events.dropDuplicates(["event_id"])
    events.write.mode("append").parquet(path)


def fan_out(items: DataFrame, root: str, layers: Sequence[str], properties: Sequence[str], stats: DataFrame) -> None:
    """Snapshot, layers and statistics from one classified frame.

    The frame is written once and read back, so the other products do not classify again and a
    lost executor does not repeat the classification.
    """
    items.write.mode("overwrite").parquet(root + "/snapshot")
    stored = items.sparkSession.read.parquet(root + "/snapshot")
    write_layers(stored, root + "/layers", properties, layers)
    stats.write.mode("overwrite").json(root + "/stats")


def evidence_features(states: DataFrame, detections: DataFrame, key: str = "detection_id") -> DataFrame:
    """Detections with their match context as GeoJSON text."""
    joined = detections.join(states, key, "left")
    return joined.select(key, feature_text(
        point_geometry(F.col("longitude"), F.col("latitude")),
        ["match_state", "selected_mmsi", "alternatives", "ambiguity_reason"], F.col(key)).alias("value"))
