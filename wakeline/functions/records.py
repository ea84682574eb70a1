"""Row-level quality, category and id expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions.text import col, let, norm_digits, norm_text, parse_float, present

SENTINELS = {"sog": 102.2, "cog": 360.0, "heading": 511.0}


def clean_motion(value: Column | str, kind: str) -> Column:
    """Speed, course or heading inside its valid range, else NULL."""
    kept = let(parse_float(value), lambda n: F.when((n >= 0) & (n < SENTINELS[kind]), n))
    return F.round(kept, 0).cast("int") if kind == "heading" else F.round(kept, 2)


def is_sentinel(value: Column | str, kind: str) -> Column:
    """A number is present but outside the valid range."""
    number = parse_float(value)
    return F.coalesce((number < 0) | (number >= SENTINELS[kind]), F.lit(False))


def record_score(columns) -> Column:
    """How many of the scored fields a record fills."""
    total = F.lit(0)
    for name in P.SCORED_FIELDS:
        if name in columns:
            total = total + present(name).isNotNull().cast("int")
    return total


def row_sha256(struct: Column) -> Column:
    return F.sha2(F.to_json(struct), 256)


def short_sha1(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.left(F.sha1(F.concat_ws("|", *parts)), F.lit(18)))


def event_id(*parts: Column) -> Column:
    return F.left(F.sha2(F.concat_ws("|", *parts), 256), F.lit(24))


def slot_dedupe_key(slot: Column, mmsi, imo, categories: Column) -> Column:
    empty = F.lit("")
    return F.concat_ws("|", slot, F.coalesce(norm_digits(mmsi), empty), F.coalesce(norm_digits(imo), empty),
                       F.array_join(F.array_sort(categories), ","))


def is_tanker(ship_type, *texts) -> Column:
    """Type code 80-89, else a tanker word in type or destination text (never the name)."""
    code = F.floor(parse_float(ship_type))
    words = norm_text(F.concat_ws(" ", *[present(t) for t in texts]))
    return F.coalesce(code.between(80, 89), F.lit(False)) | F.coalesce(words.rlike(P.TANKER_PATTERN), F.lit(False))


def zone_ids(lat: Column, lon: Column, tanker: Column) -> Column:
    """Ids of the tanker zones a tanker lies in."""
    zones = ", ".join(f"struct('{z}' AS id, {s}D AS s, {n}D AS n, {w}D AS w, {e}D AS e)"
                      for z, _label, s, n, w, e in P.TANKER_ZONES)
    hit = F.filter(F.expr(f"array({zones})"), lambda z: lat.between(z["s"], z["n"]) & lon.between(z["w"], z["e"]))
    return F.when(F.coalesce(tanker, F.lit(False)), F.transform(hit, lambda z: z["id"])).otherwise(
        F.expr("CAST(array() AS ARRAY<STRING>)"))


def primary_category(categories: Column) -> Column:
    """Highest-ranked category, 'watchlist' when there is none."""
    out = F.lit("watchlist")
    for name in sorted(P.CATEGORY_RANK, key=P.CATEGORY_RANK.get):
        out = F.when(F.array_contains(categories, name), name).otherwise(out)
    return out


def viewer_category(categories: Column, priority: Column) -> Column:
    out = F.when(priority, "watchlist").otherwise("neutral_tanker_context")
    for name in reversed(P.VIEWER_CATEGORY_ORDER):
        out = F.when(F.array_contains(categories, name), name).otherwise(out)
    return out


def priority_flag(categories: Column, *flags: Column) -> Column:
    listed = F.arrays_overlap(categories, F.array(*[F.lit(c) for c in P.KNOWN_CATEGORIES]))
    any_flag = F.lit(False)
    for flag in flags:
        any_flag = any_flag | F.coalesce(flag, F.lit(False))
    return (listed | any_flag) & ~(categories == F.array(F.lit("neutral_tanker_context")))


def quality_struct(basis: Column, sog, cog, heading, valid: Column) -> Column:
    return F.struct((basis != "source_timestamp").alias("timestamp_repaired"),
                    is_sentinel(sog, "sog").alias("sog_invalid_sentinel"),
                    is_sentinel(cog, "cog").alias("cog_invalid_sentinel"),
                    is_sentinel(heading, "heading").alias("heading_invalid_sentinel"),
                    valid.alias("has_valid_position"))


def collect_flags(**conditions: Column) -> Column:
    """Sorted names of the true conditions."""
    return F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()])))


def snapshot_tone(generated_at: Column, snapshot_at: Column, complete: Column, as_of: Column,
                  expected_hours: float, hard_hours: float) -> Column:
    """red, orange or green from completeness and build age."""
    age = (F.unix_micros(as_of) - F.unix_micros(generated_at)) / 3.6e9
    return (F.when(generated_at.isNull() | snapshot_at.isNull(), "red")
            .when(age > hard_hours, "red")
            .when(complete & (age <= expected_hours), "green").otherwise("orange"))


def nonneg(value: Column) -> Column:
    return F.greatest(F.lit(0.0), value)


def rounded(value: Column | str, places: int) -> Column:
    return F.round(col(value), places)


def scaled_round(value: Column | str, places: int) -> Column:
    """Rounded as most engines round doubles: the nearest whole number of ``value * 10^places``, halves away from zero.

    ``F.round`` goes by the shortest decimal of the value instead, which differs where the product is a half."""
    scale = 10.0 ** places
    return F.round(col(value) * scale) / scale
