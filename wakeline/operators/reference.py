"""Reference geometry and catalogue rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.text import collapse, first_nonempty, scene_id
from wakeline.operators.spatial import extents, overlaps_box


def type_score(name: Column, title: Column, abstract: Column, include_any=(), include_all=(), exclude=(), exact=()
               ) -> Column:
    """How well a feature type fits a layer rule; not positive means it does not."""
    low = lambda c: F.lower(F.coalesce(collapse(c), F.lit("")))
    n, t = low(name), low(title)
    text = low(F.concat_ws(" ", name, title, abstract))
    any_of = lambda hay, words: F.greatest(F.lit(0), *[hay.contains(w).cast("int") for w in words], F.lit(0))
    hits = sum((text.contains(w).cast("int") for w in include_any), F.lit(0))
    missing = F.lit(False)
    for w in include_all:
        missing = missing | ~text.contains(w)
    score = (hits * 10 + len(include_all) * 5 + any_of(t, include_any) * 2 + any_of(n, include_any)).cast("double")
    none = (hits == 0) if include_any else F.lit(False)
    return (F.when(n.isin(*exact) if exact else F.lit(False), 1000.0).when(any_of(text, exclude) == 1, -100.0)
            .when(missing, -50.0).when(none, -10.0).otherwise(score))


def choose_types(types: DataFrame, score: Column, name: str, max_types: int | None = None, slack: float = 4.0) -> DataFrame:
    """Types within ``slack`` of the best score, best first, at most ``max_types`` if that is given."""
    scored = types.withColumn("score", score).where("score > 0")
    best = scored.agg(F.greatest(F.lit(1.0), F.max("score") - slack))
    near = scored.where(F.col("score") >= best.scalar()).orderBy(F.col("score").desc(), F.col(name))
    return near if max_types is None else near.limit(max_types)


def features_in_box(verts: DataFrame, box: tuple, feature: str = "feature_id") -> DataFrame:
    """Ids and extents of features whose extent overlaps the box."""
    return extents(verts, feature).where(overlaps_box(*box))


def clean_features(features: DataFrame, identity: Column) -> DataFrame:
    """One feature per id or content hash."""
    return features.withColumn("_key", identity).dropDuplicates(["_key"]).drop("_key")


def content_identity(feature_id: str, *parts: str) -> Column:
    return F.coalesce(F.col(feature_id).cast("string"), F.sha1(F.to_json(F.struct(*parts))))


SCENE_ID_FIELDS = ("id", "title", "productIdentifier", "sentinel1ProductId", "s1_product_id", "product_id",
                   "product_name")


def find_scene(items: DataFrame, wanted: str, fields=SCENE_ID_FIELDS) -> DataFrame:
    """Items any of whose ids equals the wanted scene."""
    present = [f for f in fields if f in items.columns]
    ids = F.array(*[scene_id(f) for f in present])
    return items.where(F.array_contains(ids, scene_id(F.lit(wanted))))


def require_one(items: DataFrame, row: str) -> DataFrame:
    """The single item; zero or several fail the job."""
    counted = items.groupBy().agg(F.count("*").alias("n"), F.min(row).alias(row))
    return counted.select(F.when(F.col("n") == 1, F.col(row)).otherwise(F.raise_error(F.concat(
        F.lit("expected one exact match, found "), F.col("n").cast("string")))).alias(row))


def scene_summary(items: DataFrame) -> DataFrame:
    """Catalogue metadata with fallbacks; asset sizes as a map without non-positive entries."""
    p = lambda name: F.col("properties")[name]
    sizes = F.map_filter("assets", lambda _k, v: F.coalesce(v > 0, F.lit(False)))
    return items.select(
        F.col("id").alias("item_id"), first_nonempty("collection", F.lit("sentinel-1-grd")).alias("collection"),
        first_nonempty(p("start_datetime"), p("datetime")).alias("start_datetime"),
        first_nonempty(p("end_datetime"), p("datetime")).alias("end_datetime"), p("platform").alias("platform"),
        p("sar:instrument_mode").alias("instrument_mode"),
        first_nonempty(p("sar:polarizations"), p("s1:polarization")).alias("polarizations"),
        p("sat:orbit_state").alias("orbit_state"), sizes.alias("asset_sizes_bytes"),
        F.coalesce(p("product_size").try_cast("bigint"), sizes["Product"]).alias("product_size_bytes"))
