"""Readers for the files the feeds land as. Explicit schemas; bad rows are counted, not lost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline import params as P
from wakeline.functions.text import present
from wakeline.sources.json_lists import read_lists

CORRUPT = "_corrupt"
REPORT_SCHEMA = ("entries array<map<string, array<struct<date:string, lat:double, lon:double, vesselId:string,"
                 " imo:string, mmsi:string, callsign:string, shipName:string, flag:string, vesselType:string,"
                 " detections:double, hours:double, entryTimestamp:string>>>>")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.format("binaryFile").load(path).select("path").isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_header_csv(spark: SparkSession, path: str, columns: Sequence[str], line_breaks: bool = False) -> DataFrame:
    """Header CSV as text columns by name; a missing file is an empty table, a byte-order mark is dropped.

    Files are split between tasks unless ``line_breaks`` says that quoted fields may hold line breaks.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], string_schema(columns))
    raw = spark.read.csv(path, header=True, multiLine=line_breaks, escape='"', enforceSchema=False)
    named = raw.select(*[F.col(f"`{c}`").alias(c.lstrip("﻿").strip()) for c in raw.columns])
    return named.select(*[F.col(c) if c in named.columns else F.lit(None).cast("string").alias(c) for c in columns])


def read_archive_csv(spark: SparkSession, path: str) -> DataFrame:
    """Positional 26-column daily CSV; ``column_count`` tells rows of the wrong width apart.

    Two extra trailing columns make surplus fields visible; header rows anywhere stay as rows and
    are rejected by reason later.
    """
    columns = [*P.ARCHIVE_COLUMNS, "_extra"]
    schema = T.StructType([*string_schema(columns).fields, T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.csv(path, schema=schema, header=False, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
                          quote='"', escape='"')
    # A row of exactly 26 fields is malformed against 27 columns, and only its last one is NULL.
    bare = F.regexp_replace(F.col(CORRUPT), r'"(?:[^"]|"")*"', "q")  # commas inside quotes part no fields
    width = (F.when(F.col("_extra").isNotNull(), 27)
             .when(F.col("size_d").isNotNull() | (F.size(F.split(bare, ",")) >= 26), 26).otherwise(0))
    return rows.select(*P.ARCHIVE_COLUMNS, width.alias("column_count"))


def envelope_rows(texts: DataFrame, fields: T.StructType, column: str = "value") -> DataFrame:
    """Rows of envelope texts: a list, or an object with contacts, vessels or data."""
    rows = T.ArrayType(fields)
    parts = [F.from_json(F.get_json_object(column, f"$.{k}"), rows) for k in ("contacts", "vessels", "data")]
    is_list = F.substring(F.ltrim(column), 1, 1) == "["
    picked = F.when(is_list, F.from_json(column, rows)).otherwise(F.coalesce(*parts))
    return texts.select(F.explode(picked).alias("c")).select("c.*")


def read_contacts(spark: SparkSession, candidates: Sequence[str], fields: T.StructType) -> DataFrame:
    """Contacts of the first existing path; a file is split between tasks."""
    for path in candidates:
        if _exists(spark, path):
            listed = read_lists(spark, path, ("contacts", "vessels", "data"))
            return listed.select(F.from_json("record", fields).alias("c")).select("c.*")
    return spark.createDataFrame([], fields)


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], fields: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of JSON Lines: blank lines are skipped, malformed and non-object lines rejected."""
    lines = spark.read.text(paths).where(present("value").isNotNull())
    return split_jsonl(lines, fields)


def split_jsonl(lines: DataFrame, fields: T.StructType, column: str = "value") -> tuple[DataFrame, DataFrame]:
    schema = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = lines.select(F.col(column), F.from_json(column, schema, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    is_object = F.substring(F.ltrim(column), 1, 1) == "{"
    good = is_object & F.col(f"r.{CORRUPT}").isNull()
    names = [f"r.{f.name}" for f in fields.fields]
    return parsed.where(good).select(*names), parsed.where(~good).select(column)


def history_paths(spark: SparkSession, shard_dir: str, legacy: str, manifest: str = "manifest.json") -> list[str]:
    """Files to read: the manifest's parts, else loose shards, else the legacy file.

    Only the manifest is read on the driver; it has one entry per file.
    """
    where = f"{shard_dir}/{manifest}"
    if _exists(spark, where):
        text = spark.read.text(where, wholetext=True)
        names = text.select(F.explode(F.from_json(F.get_json_object("value", "$.parts"),
                                                  "array<struct<filename:string>>")).alias("p")).select("p.filename")
        return [f"{shard_dir}/{row.filename}" for row in names.toLocalIterator()]
    loose = f"{shard_dir}/*.jsonl"
    if _exists(spark, loose):
        return [loose]
    return [legacy] if _exists(spark, legacy) else []


def read_history(spark: SparkSession, shard_dir: str, legacy: str, fields: T.StructType) -> tuple[DataFrame, DataFrame]:
    paths = history_paths(spark, shard_dir, legacy)
    if not paths:
        empty = spark.createDataFrame([], fields)
        return empty, spark.createDataFrame([], "value string")
    return read_jsonl(spark, paths, fields)


FEATURE = "struct<id:string,properties:map<string,string>,geometry:string>"


def feature_rows(payload: DataFrame, layer: str, column: str = "value") -> DataFrame:
    """Features of GeoJSON FeatureCollection texts: id (``layer:index`` if missing), properties, geometry text."""
    listed = F.from_json(F.get_json_object(column, "$.features"), f"array<{FEATURE}>")
    return features_of(payload.select(F.posexplode(listed).alias("index", "f")), layer)


def features_of(rows: DataFrame, layer: str) -> DataFrame:
    """Feature columns of rows (index, f)."""
    kind = F.get_json_object("f.geometry", "$.type")
    return rows.select(
        F.coalesce(present("f.id"), F.concat(F.lit(layer + ":"), F.col("index").cast("string"))).alias("feature_id"),
        F.lit(layer).alias("infrastructure_type"), F.col("f.properties").alias("properties"),
        F.col("f.geometry").alias("geometry"), kind.alias("geometry_type"), "index")


def read_geojson(spark: SparkSession, layers: dict[str, str]) -> DataFrame:
    """Features of all layers (name to path); missing files contribute none, large ones are split between tasks."""
    out = None
    for layer, path in layers.items():
        if not _exists(spark, path):
            continue
        part = features_of(read_lists(spark, path, ("features",)).select("index", F.from_json("record", FEATURE).alias("f")), layer)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise FileNotFoundError("no reference layer found")
    return out


def region_rows(features: DataFrame) -> DataFrame:
    """Polygon features as query regions; none at all fails the job."""
    keep = features.where(F.col("geometry_type").isin("Polygon", "MultiPolygon"))
    fallback = F.concat(F.lit("region_"), (F.col("index") + 1).cast("string"))
    rid = F.coalesce(present(F.col("properties")["id"]), fallback)
    rows = keep.select(rid.alias("region_id"), F.coalesce(present(F.col("properties")["name"]), rid).alias("region_name"),
                       present(F.col("properties")["note"]).alias("note"), "geometry")
    enough = keep.agg(F.when(F.count("*") > 0, True).otherwise(F.raise_error(F.lit("no polygon regions")).cast(
        "boolean")))
    return rows.where(enough.scalar())


WRAPPERS = ("features", "vessels", "locations", "data", "items", "results")


def any_records(payload: DataFrame, column: str = "value") -> DataFrame:
    """Records (JSON text) of an array, a FeatureCollection, the first wrapped list, or the object itself."""
    kind = F.substring(F.ltrim(column), 1, 1)
    # A wrapper counts only when it is a list.
    wrapped = [F.when(F.substring(F.get_json_object(column, f"$.{k}"), 1, 1) == "[", F.get_json_object(
        column, f"$.{k}")) for k in WRAPPERS]
    text = F.when(kind == "[", F.col(column)).otherwise(F.coalesce(*wrapped))
    records = F.coalesce(F.from_json(text, "array<string>"), F.array(F.col(column)))
    out = payload.select(F.explode(records).alias("record"))
    return out.where(F.substring(F.ltrim("record"), 1, 1) == "{")


def flatten_report(reports: DataFrame, entries: str = "entries", prefixes=("public-global-presence:",)) -> DataFrame:
    """Gridded report rows tagged with their dataset key; ``dataset_version`` is the resolved one."""
    per_entry = reports.select(F.explode(entries).alias("e")).select(F.explode("e").alias("source_dataset", "rows"))
    version = F.lit(False)
    for p in prefixes:
        version = version | F.col("source_dataset").startswith(p)
    return per_entry.select("source_dataset", F.when(version, F.col("source_dataset")).alias("dataset_version"),
                            F.explode("rows").alias("r")).select("source_dataset", "dataset_version", "r.*")


def explode_positions(contacts: DataFrame, child: Sequence[str], positions: str = "positions") -> DataFrame:
    """Contact times positions; child fields override the contact's; no list keeps the contact itself."""
    none = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in
                      contacts.schema[positions].dataType.elementType.fields])
    listed = F.when(F.size(F.coalesce(positions, F.array())) > 0, F.col(positions)).otherwise(F.array(none))
    out = contacts.withColumn("_p", F.explode(listed))
    for name in child:
        out = out.withColumn(name, F.coalesce(F.col("_p")[name], F.col(name)) if name in contacts.columns
                             else F.col("_p")[name])
    return out.drop("_p", positions)


def choose_source(spark: SparkSession, full: str, fallback: str, schema: T.StructType) -> DataFrame:
    """Full product, else the limited fallback marked incomplete, else no rows; scope columns added."""
    for path, scope, complete in ((full, "full", True), (fallback, "limited", False)):
        if _exists(spark, path):
            rows = spark.read.schema(schema).json(path)
            return rows.withColumn("coverage_scope", F.lit(scope)).withColumn("coverage_complete", F.lit(complete))
    return (spark.createDataFrame([], schema).withColumn("coverage_scope", F.lit("missing"))
            .withColumn("coverage_complete", F.lit(False)))


MESSAGE_SCHEMA = T.StructType([
    T.StructField("MessageType", T.StringType()),
    T.StructField("MetaData", T.MapType(T.StringType(), T.StringType())),
    T.StructField("Message", T.MapType(T.StringType(), T.StringType())),
])
POSITION_TYPES = ("PositionReport", "StandardClassBPositionReport", "ExtendedClassBPositionReport")


def message_contacts(messages: DataFrame, value: str = "value") -> DataFrame:
    """Tagged-union AIS messages (JSON text) to flat contact columns. Works on batch and streaming frames."""
    kind = F.get_json_object(value, "$.MessageType")
    meta = F.coalesce(F.get_json_object(value, "$.MetaData"), F.get_json_object(value, "$.Metadata"))
    body = F.from_json(F.get_json_object(value, "$.Message"), "map<string,string>")[kind]
    m = lambda k: present(F.get_json_object(meta, f"$.{k}"))
    b = lambda k: present(F.get_json_object(body, f"$.{k}"))
    moving = kind.isin(*POSITION_TYPES)
    static, report = kind == "ShipStaticData", kind == "StaticDataReport"
    known = moving | static | report
    out = {
        "message_type": kind,
        "mmsi": F.coalesce(F.when(known, b("UserID")), m("MMSI")),
        "imo": F.when(static, b("ImoNumber")),
        "callsign": F.when(static, b("CallSign")).when(report, b("ReportB.CallSign")),
        "name": F.when(moving, F.coalesce(m("ShipName"), b("Name"))).when(static, F.coalesce(b("Name"), m("ShipName")))
        .when(report, F.coalesce(b("ReportA.Name"), m("ShipName"))).otherwise(m("ShipName")),
        "latitude": F.coalesce(F.when(moving, b("Latitude")), m("latitude"), m("Latitude")).try_cast("double"),
        "longitude": F.coalesce(F.when(moving, b("Longitude")), m("longitude"), m("Longitude")).try_cast("double"),
        "destination": F.when(static, b("Destination")),
        "ship_type": F.when(static, b("Type")).when(report, b("ReportB.ShipType")),
        "navigational_status": F.when(moving, b("NavigationalStatus")),
        "sog": F.when(moving, b("Sog")).try_cast("double"), "cog": F.when(moving, b("Cog")).try_cast("double"),
        "true_heading": F.when(moving, b("TrueHeading")).try_cast("double"),
        "last_seen_utc": m("time_utc"),
    }
    carried = [c for c in messages.columns if c != value]
    return messages.select(*carried, *[c.alias(n) for n, c in out.items()])


def column_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind).alias(name)
