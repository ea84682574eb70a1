"""Identity, flag, port and zone matching.

Reference tables are joined without broadcast hints: Spark broadcasts a side only when its
measured size is below the session's threshold, and splits skewed shuffle partitions otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions import identity
from wakeline.functions.records import is_tanker, zone_ids
from wakeline.functions.tables import fixed_table
from wakeline.functions.text import norm_digits, norm_key, norm_text, present, split_tokens, to_bool
from wakeline.session import cut_lineage, stored

ID_KINDS = ("imo", "mmsi", "callsign")


def normalised_ids(kind: str) -> Column:
    return norm_text(kind) if kind == "callsign" else norm_digits(kind)


def spread_nulls(key: Column, df: DataFrame, spread: int = 4096) -> Column:
    """The key, or for NULL a text that matches nothing and differs between rows, so that rows without a key
    do not meet in one partition of a left join."""
    plain = [F.col(c) for c, kind in df.dtypes if not kind.startswith(("map", "array", "struct"))]
    return F.coalesce(key, F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*plain), F.lit(spread)).cast("string")))


# --- watchlist -----------------------------------------------------------------------

def watch_index(watch: DataFrame, kind: str, line: str = "line_no") -> DataFrame:
    """One watchlist row per id value; the last line wins on duplicates."""
    row = F.struct(*watch.columns)
    return (watch.withColumn("_id", normalised_ids(kind)).where("_id IS NOT NULL")
            .groupBy("_id").agg(F.max_by(row, F.col(line)).alias(f"_{kind}_row")))


def match_watchlist(contacts: DataFrame, watch: DataFrame, line: str = "line_no", kinds=ID_KINDS,
                    prefix: str = "watch_") -> DataFrame:
    """Adds ``matched_on`` and the prefixed watchlist columns. Names are never matched."""
    out = contacts.select("*", *[spread_nulls(normalised_ids(k), contacts).alias(f"_{k}_key") for k in kinds])
    for kind in kinds:
        index = watch_index(watch, kind, line).withColumnRenamed("_id", f"_{kind}_id")
        out = out.join(index, F.col(f"_{kind}_key") == F.col(f"_{kind}_id"), "left")
    rows = [F.col(f"_{k}_row") for k in kinds]
    on = F.coalesce(*[F.when(r.isNotNull(), F.lit(k)) for k, r in zip(kinds, rows)])
    out = out.select(*contacts.columns, on.alias("matched_on"), F.coalesce(*rows).alias("_w"))
    return out.select(*contacts.columns, "matched_on", *[F.col(f"_w.{c}").alias(prefix + c) for c in watch.columns])


def watch_match_basis(records: DataFrame, watch: DataFrame, line: str = "line_no") -> DataFrame:
    """Radar records against 7-digit IMO first, then 9-digit MMSI; every hit id is in ``match_basis``."""
    out = records
    sizes = {"imo": 7, "mmsi": 9}
    for kind, size in sizes.items():
        # Stored, as Spark takes the ids of a watchlist for as large as the list, and would deal out all records for them.
        index = stored(watch_index(watch.select(line, "name", kind), kind, line).where(F.length("_id") == size).select(
            F.col("_id").alias(f"_{kind}_id"), F.struct(F.col(f"_{kind}_row.name").alias("name")).alias(f"_{kind}_row")))
        out = out.withColumn(f"_{kind}_key", spread_nulls(normalised_ids(kind), records)).join(
            index, F.col(f"_{kind}_key") == F.col(f"_{kind}_id"), "left")
    out = (out.withColumn("_w", F.coalesce("_imo_row", "_mmsi_row"))
           .withColumn("watchlist_match", F.col("_w").isNotNull())
           .withColumn("match_basis", F.array_compact(F.array(
               F.when(F.col("_imo_row").isNotNull(), "imo"), F.when(F.col("_mmsi_row").isNotNull(), "mmsi"))))
           .withColumn("watchlist_name", F.col("_w.name")))
    return out.drop("_w", *[f"_{k}_{s}" for k in sizes for s in ("row", "key", "id")])


def watch_categories(dialect: str = "archive", mmsi: str = "mmsi") -> Column:
    """Watchlist flag columns to categories, in one of three dialects: archive, grid, snapshot."""
    flag = lambda name: to_bool(F.col(name).cast("string"))
    if dialect == "archive":
        pairs = [("sanctions_shadowfleet", flag("track_sanctions") | flag("track_shadowfleet")),
                 ("falseflag_interest", flag("track_falseflag")),
                 ("behavioral_voi", flag("track_behavior")),
                 ("russian_mmsi", F.coalesce(norm_digits(mmsi).startswith("273"), F.lit(False)))]
    else:
        pairs = [("sanctions_shadowfleet", flag("track_sanctions")), ("shadowfleet", flag("track_shadowfleet")),
                 ("falseflag_interest", flag("track_falseflag")), ("behavioral_voi", flag("track_behavior"))]
    found = F.array(F.lit("watchlist"), *[F.when(cond, F.lit(name)) for name, cond in pairs])
    return F.array_sort(F.array_compact(found))


# --- known categories ----------------------------------------------------------------

def category_index(sources: DataFrame) -> DataFrame:
    """(kind, value) to the union of categories over all exact ids. ``categories`` is an array column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), normalised_ids(k).alias("value"))
                                for k in ID_KINDS]))
    return (sources.select("categories", pairs.alias("id")).where("id.value IS NOT NULL")
            .select("id.kind", "id.value", F.explode("categories").alias("category")).distinct()
            .groupBy("kind", "value").agg(F.array_sort(F.collect_set("category")).alias("categories")))


def unique_names(sources: DataFrame) -> DataFrame:
    """Names that belong to exactly one identity, with their categories."""
    signature = F.coalesce(norm_digits("imo"), norm_digits("mmsi"), norm_text("callsign"), norm_key("name"))
    named = (sources.withColumn("name_key", norm_key("name")).withColumn("signature", signature)
             .where("name_key IS NOT NULL"))
    single = (named.groupBy("name_key").agg(F.min("signature").alias("lo"), F.max("signature").alias("hi"))
              .where("lo = hi").select("name_key", F.col("lo").alias("signature")))
    return (named.select("name_key", F.explode("categories").alias("category")).distinct()
            .groupBy("name_key").agg(F.array_sort(F.collect_set("category")).alias("categories"))
            .join(single, "name_key"))


def match_known(contacts: DataFrame, sources: DataFrame) -> DataFrame:
    """Union of categories over all exact id hits, else over an unambiguous name; MMSI 273 adds its own.

    Works per distinct identity, so repeated positions of a vessel are not joined one by one.
    """
    ids = contacts.select("imo", "mmsi", "callsign", "name").distinct()
    index = category_index(sources)
    out = ids
    empty = F.array().cast("array<string>")
    for kind in ID_KINDS:
        part = index.where(F.col("kind") == kind).select(
            F.col("value").alias(f"_{kind}_id"), F.col("categories").alias(f"_{kind}_cats"))
        out = out.withColumn(f"_{kind}_key", normalised_ids(kind)).join(
            part, F.col(f"_{kind}_key") == F.col(f"_{kind}_id"), "left")
    exact = F.array_distinct(F.flatten(F.array(*[F.coalesce(F.col(f"_{k}_cats"), empty) for k in ID_KINDS])))
    names = unique_names(sources).select(F.col("name_key").alias("_name_id"), F.col("categories").alias("_name_cats"))
    out = (out.withColumn("_exact", exact).withColumn(
        "_name_key", F.when(F.size("_exact") == 0, norm_key("name")))
        .join(names, F.col("_name_key") == F.col("_name_id"), "left"))
    russian = F.coalesce(norm_digits("mmsi").startswith("273"), F.lit(False))
    by_name = F.col("_name_cats").isNotNull()
    out = (out.withColumn("categories", F.array_sort(F.array_union(
        F.array_union("_exact", F.coalesce("_name_cats", empty)),
        F.when(russian, F.array(F.lit("russian_mmsi"))).otherwise(empty))))
        .withColumn("matched_on", F.array_sort(F.array_compact(F.array(
            *[F.when(F.col(f"_{k}_cats").isNotNull(), F.lit(k)) for k in ID_KINDS],
            F.when(by_name, F.lit("unique_name")), F.when(russian, F.lit("russian_mmsi_mid")))))))
    out = out.where(F.size("categories") > 0).select("imo", "mmsi", "callsign", "name", "categories", "matched_on")
    same = F.lit(True)
    for name in ("imo", "mmsi", "callsign", "name"):
        same = same & contacts[name].eqNullSafe(out[name])
    return contacts.join(out, same, "inner").select(contacts["*"], out["categories"], out["matched_on"])


def known_flags(categories: Column) -> dict[str, Column]:
    """Flags derived from a known match's categories."""
    has = lambda c: F.array_contains(categories, c)
    return {
        "known_voi_match": F.lit(True), "is_priority_voi": F.lit(True), "neutral_tanker_context": F.lit(False),
        "sanctioned": has("sanctions_shadowfleet"), "shadow_fleet": has("sanctions_shadowfleet"),
        "false_flag": has("falseflag_interest") | has("false_flag_watch"),
        "behavioral_voi": has("behavioral_voi"), "from_russia_confirmed": has("recent_russian_portcall_10d"),
        "voi_role": F.lit("known_voi_or_watchlist_historical_match"), "index_impact": F.lit("voi_context"),
    }


# --- flag state ----------------------------------------------------------------------

def flag_table(flags: DataFrame) -> DataFrame:
    """Active flag rows with their lookup keys."""
    return (flags.where(F.coalesce(to_bool(F.col("active").cast("string")), F.lit(True)))
            .withColumn("name_key", norm_key("state_name")).withColumn("iso_key", norm_text("iso_code")))


def mid_table(flags: DataFrame) -> DataFrame:
    """MMSI prefix to flag state: the table's own prefixes first, then the fixed fallback."""
    spark = flags.sparkSession
    listed = (flag_table(flags).select(F.explode(split_tokens("mmsi_mid_prefixes")).alias("m"), "state_name", "line_no")
              .select(F.left(norm_digits("m"), F.lit(3)).alias("mid"), "state_name", "line_no").where("mid IS NOT NULL")
              .groupBy("mid").agg(F.max_by("state_name", "line_no").alias("state_name")).withColumn("pref", F.lit(0)))
    fallback = fixed_table(spark, ("mid", "state_name"), P.MID_FLAGS.items()).withColumn("pref", F.lit(1))
    return listed.unionByName(fallback).groupBy("mid").agg(F.min_by("state_name", "pref").alias("state_name"))


def resolve_flag(contacts: DataFrame, flags: DataFrame) -> DataFrame:
    """``flag_detected`` and ``flag_source``: explicit name, ISO code, raw text, else MMSI prefix."""
    table = flag_table(flags)
    by_name = table.groupBy("name_key").agg(F.max_by("state_name", "line_no").alias("_by_name")).where(
        "name_key IS NOT NULL")
    by_iso = table.groupBy("iso_key").agg(F.max_by("state_name", "line_no").alias("_by_iso")).where(
        "iso_key IS NOT NULL")
    by_mid = mid_table(flags).withColumnRenamed("state_name", "_by_mid")
    raw = present("flag")
    digits = norm_digits("mmsi")
    out = (contacts.withColumns({
        "_raw": raw, "_fk": spread_nulls(norm_key("flag"), contacts), "_fi": spread_nulls(norm_text("flag"), contacts),
        "_mid": F.when(raw.isNull() & (F.length(digits) >= 3), F.left(digits, F.lit(3)))})
           .withColumn("_midk", spread_nulls(F.col("_mid"), contacts))
           .join(by_name, F.col("_fk") == F.col("name_key"), "left")
           .join(by_iso, F.col("_fi") == F.col("iso_key"), "left")
           .join(by_mid, F.col("_midk") == F.col("mid"), "left"))
    detected = (F.when(F.col("_raw").isNotNull(), F.coalesce("_by_name", "_by_iso", "_raw")).otherwise(F.col("_by_mid")))
    source = (F.when(F.col("_by_name").isNotNull(), "explicit_flag").when(F.col("_by_iso").isNotNull(), "explicit_iso")
              .when(F.col("_raw").isNotNull(), "explicit_flag")
              .when(F.col("_by_mid").isNotNull(), F.concat(F.lit("mmsi_mid:"), F.col("_mid"))))
    return out.select(*contacts.columns, detected.alias("flag_detected"), source.alias("flag_source"))


def flag_band(category: Column, status: Column) -> Column:
    hard = (category == "A") | status.isin(*P.HARD_REGISTRY_STATUSES)
    context = (category == "C") | status.isin(*P.CONTEXT_REGISTRY_STATUSES)
    return F.when(F.coalesce(hard, F.lit(False)), "hard").when(F.coalesce(context, F.lit(False)), "context"
                                                               ).otherwise("soft")


def flag_score(category: Column) -> Column:
    out = F.lit(P.FLAG_RISK_DEFAULT_SCORE)
    for name, score in P.FLAG_RISK_SCORES.items():
        out = F.when(category == name, score).otherwise(out)
    return out


def assess_flag(contacts: DataFrame, flags: DataFrame) -> DataFrame:
    """Adds flag risk columns; NULL where the detected flag is not in the table."""
    table = flag_table(flags)
    risk = F.struct(F.upper(present("risk_category")).alias("category"), present("registry_status").alias("status"),
                    F.col("state_name").alias("state"), F.col("iso_key").alias("iso"))
    by_name = table.where("name_key IS NOT NULL").groupBy("name_key").agg(F.max_by(risk, "line_no").alias("_rn"))
    by_iso = table.where("iso_key IS NOT NULL").groupBy("iso_key").agg(F.max_by(risk, "line_no").alias("_ri"))
    resolved = resolve_flag(contacts, flags)
    out = (resolved.withColumns({"_k": spread_nulls(norm_key("flag_detected"), contacts),
                                 "_i": spread_nulls(norm_text("flag_detected"), contacts)})
           .join(by_name, F.col("_k") == F.col("name_key"), "left")
           .join(by_iso, F.col("_i") == F.col("iso_key"), "left")
           .select(*resolved.columns, F.coalesce("_rn", "_ri").alias("_r")))
    known = F.col("_r").isNotNull()
    return out.select(
        *resolved.columns, F.col("_r.category").alias("flag_risk_category"),
        F.col("_r.status").alias("flag_registry_status"), F.col("_r.iso").alias("flag_iso_code"),
        F.when(known, flag_band(F.col("_r.category"), F.col("_r.status"))).alias("flag_risk_band"),
        F.when(known, flag_score(F.col("_r.category"))).alias("flag_risk_score"))


# --- ports ---------------------------------------------------------------------------

def port_terms(ports: DataFrame) -> DataFrame:
    """(term, kind): codes and names from the port tables, their aliases and the fixed lists."""
    spark = ports.sparkSession
    listed = ports.select(norm_key("unlocode").alias("code"), norm_key("port_name").alias("name"),
                          F.transform(split_tokens("aliases"), norm_key).alias("aliases"))
    alias = listed.select(F.explode("aliases").alias("term")).where("term IS NOT NULL")
    codes = listed.select(F.col("code").alias("term")).unionByName(
        alias.where((F.length("term") == 5) & F.col("term").startswith("RU")))
    names = listed.select(F.col("name").alias("term")).unionByName(alias)
    fixed_codes = fixed_table(spark, ("term",), [(c,) for c in P.PORT_CODE_ALLOWLIST])
    fixed_names = fixed_table(spark, ("term",), [(n,) for n in P.PORT_NAME_ALIASES]).select(
        norm_key("term").alias("term"))
    return (codes.unionByName(fixed_codes).withColumn("kind", F.lit("code"))
            .unionByName(names.unionByName(fixed_names).withColumn("kind", F.lit("name")))
            .where("term IS NOT NULL").distinct())


ANCHOR = 4


def port_hits(texts: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """(text, hits, matched) per distinct text with any hit.

    Every position of the normalised text gives one window as long as the longest term. Windows
    and terms are equi-joined on their first 4 letters, then the whole term is checked, so no text
    is compared with every term and long texts cost a row per letter, not a copy. Codes need 5
    letters and names 4. Denied ports (names anywhere, codes as two-plus-three letter tokens) show
    up in ``hits`` but never make a match alone.
    """
    distinct = texts.select(text).where(present(text).isNotNull()).distinct().withColumns(
        {"_id": F.md5(text), "_c": norm_key(text)})
    long_enough = F.length("term") >= F.when(F.col("kind") == "code", 5).otherwise(4)
    wanted = terms.where(long_enough).select("term", F.left("term", F.lit(ANCHOR)).alias("_a")).distinct()
    longest = wanted.agg(F.max(F.length("term")).cast("string")).scalar()
    pattern = F.concat(F.lit(f"(?=(.{{{ANCHOR},"), longest, F.lit("}))"))
    windows = distinct.select("_id", F.explode(F.regexp_extract_all("_c", pattern, F.lit(1))).alias("_w"))
    found = (windows.join(wanted, F.left("_w", F.lit(ANCHOR)) == F.col("_a")).where(F.startswith("_w", "term"))
             .groupBy("_id").agg(F.collect_set("term").alias("_hits")))
    tokens = F.transform(F.regexp_extract_all(norm_text(text), F.lit(r"([A-Z]{2}\s?[A-Z0-9]{3})"), 1),
                         lambda tok: F.replace(tok, F.lit(" ")))
    names = [F.when(F.contains("_c", F.lit(n)), F.lit(n)) for n in P.PORT_NAME_DENYLIST]
    denied = F.concat(F.array_intersect(tokens, F.array(*[F.lit(c) for c in P.PORT_CODE_DENYLIST])),
                      F.array_compact(F.array(*names)))
    hits = F.coalesce("_hits", F.array().cast("array<string>"))
    return (distinct.withColumn("_deny", denied).join(found, "_id", "left")
            .select(text, F.array_sort(F.array_union(hits, "_deny")).alias("hits"), (F.size(hits) > 0).alias("matched"))
            .where(F.size("hits") > 0))


def add_port_match(contacts: DataFrame, terms: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds ``<out>`` (boolean) and ``<out>_hits`` for each text column (``{column: out}``).

    Each distinct text of any of the columns is matched once.
    """
    texts = contacts.select(F.explode(F.array(*columns)).alias("_text"))
    hits = port_hits(texts, terms, "_text")
    out = contacts
    for column, name in columns.items():
        right = hits.select(F.col("_text").alias(f"_k_{name}"), F.col("hits").alias(f"_h_{name}"),
                            F.col("matched").alias(f"_m_{name}"))
        said = F.when(present(column).isNotNull(), F.col(column))  # empty texts match nothing and are spread
        out = out.join(right, spread_nulls(said, contacts) == F.col(f"_k_{name}"), "left")
    none = F.array().cast("array<string>")
    found = [c for n in columns.values() for c in (F.coalesce(f"_m_{n}", F.lit(False)).alias(n),
                                                   F.coalesce(f"_h_{n}", none).alias(n + "_hits"))]
    return out.select(*contacts.columns, *found)


# --- zones, metadata, enrichment -----------------------------------------------------

def zone_rows(points: DataFrame) -> DataFrame:
    """One row per point and overlapping tanker zone."""
    zones = F.array(*[F.struct(F.lit(z[0]).alias("zone_id"), F.lit(z[1]).alias("zone_label"), F.lit(z[2]).alias("s"),
                               F.lit(z[3]).alias("n"), F.lit(z[4]).alias("w"), F.lit(z[5]).alias("e"))
                      for z in P.TANKER_ZONES])
    hit = F.filter(zones, lambda z: F.col("latitude").between(z["s"], z["n"]) & F.col("longitude").between(
        z["w"], z["e"]))
    return points.withColumn("_z", F.explode(hit)).withColumn("zone_id", F.col("_z.zone_id")).withColumn(
        "zone_label", F.col("_z.zone_label")).drop("_z")


def attach_metadata(locations: DataFrame, metadata: DataFrame, order: str) -> DataFrame:
    """Locations with their vessel metadata by MMSI; the latest metadata row wins."""
    fields = [c for c in metadata.columns if c not in ("mmsi", order)]
    latest = (metadata.withColumn("_m", norm_digits("mmsi")).where("_m IS NOT NULL").groupBy("_m")
              .agg(F.max_by(F.struct(*fields), order).alias("_meta")))
    return locations.join(latest, norm_digits("mmsi") == F.col("_m"), "left").select(
        locations["*"], *[F.col("_meta")[f].alias(f) for f in fields])


ENRICH_FLAGS = ("is_priority_voi", "known_voi_match", "sanctioned", "shadow_fleet", "false_flag", "behavioral_voi",
                "from_russia_confirmed", "recent_russian_portcall_confirmed_10d",
                "recent_russian_portcall_unconfirmed_10d", "to_russia_declared", "neutral_tanker_context")


def classification_index(sources: DataFrame, flags=ENRICH_FLAGS) -> DataFrame:
    """Per ``imo:``/``mmsi:`` key: union of categories, OR of flags, over all classified sources."""
    keys = F.array_compact(F.array(
        F.when(F.length(norm_digits("imo")) == 7, F.concat(F.lit("imo:"), norm_digits("imo"))),
        F.when(F.length(norm_digits("mmsi")) == 9, F.concat(F.lit("mmsi:"), norm_digits("mmsi")))))
    keyed = sources.withColumn("identity_key", F.explode(keys))
    per_key = keyed.groupBy("identity_key").agg(*[F.bool_or(F.coalesce(f, F.lit(False))).alias(f) for f in flags])
    cats = (keyed.select("identity_key", F.explode("categories").alias("c")).distinct().groupBy("identity_key")
            .agg(F.array_sort(F.collect_set("c")).alias("categories")))
    return per_key.join(cats, "identity_key", "left")


def enrich(rows: DataFrame, index: DataFrame, flags=ENRICH_FLAGS) -> DataFrame:
    present_flags = [f for f in flags if f in index.columns]
    empty = F.array().cast("array<string>")
    right = index.select(F.col("identity_key").alias("_k"), F.col("categories").alias("_cats"),
                         *[F.col(f).alias("_f_" + f) for f in present_flags])
    out = rows.join(right, F.col("identity_key") == F.col("_k"), "left")
    own = F.col("categories") if "categories" in rows.columns else empty
    out = out.withColumn("categories", F.array_sort(F.array_union(F.coalesce(own, empty), F.coalesce("_cats", empty))))
    for f in present_flags:
        out = out.withColumn(f, F.coalesce("_f_" + f, F.lit(False)))
    return out.drop("_k", "_cats", *["_f_" + f for f in present_flags])


# --- keep filter ---------------------------------------------------------------------

def keep_flags(contacts: DataFrame, watch: DataFrame, terms: DataFrame, risk_mids: DataFrame) -> DataFrame:
    """Boolean keep reasons per contact; ``keep`` is their OR.

    The route flags (``recent_unconfirmed``, ``recent_confirmed``) count where the contacts carry them.
    """
    out = contacts.withColumns({"_risk": spread_nulls(F.left(norm_digits("mmsi"), F.lit(3)), contacts),
                                **{f"_k_{k}": spread_nulls(normalised_ids(k), contacts) for k in ID_KINDS}})
    for kind in ID_KINDS:
        ids = watch.select(normalised_ids(kind).alias(f"_w_{kind}")).where(f"_w_{kind} IS NOT NULL").distinct()
        out = out.join(ids, F.col(f"_k_{kind}") == F.col(f"_w_{kind}"), "left")
    out = out.join(risk_mids.select(F.col("mid").alias("_rm")).distinct(), F.col("_risk") == F.col("_rm"), "left")
    out = add_port_match(out, terms, {"destination": "_dest", "last_port": "_port"})
    tanker = is_tanker("ship_type", "ship_type_text", "destination")
    zones = zone_ids(F.col("latitude"), F.col("longitude"), tanker)
    reasons = {
        "russian_mmsi": F.coalesce(norm_digits("mmsi").startswith("273"), F.lit(False)),
        "watchlisted": F.coalesce(*[F.when(F.col(f"_w_{k}").isNotNull(), True) for k in ID_KINDS], F.lit(False)),
        "risk_mid": F.col("_rm").isNotNull(),
        "port_hit": F.col("_dest") | F.col("_port"),
        "tanker_zone": F.size(zones) > 0,
        "recent_port_call": F.coalesce(*[F.when(F.col(c), True) for c in ("recent_unconfirmed", "recent_confirmed") if c in contacts.columns],
                                       F.lit(False)),
    }
    out = out.select(*contacts.columns, *[cond.alias(name) for name, cond in reasons.items()])
    return out.withColumn("keep", F.expr(" OR ".join(reasons)))


def alias_owners(contacts: DataFrame, at: str = "observed_at", days: int = 30) -> DataFrame:
    """(period, alias, canonical, ambiguous): whom an IMO number, MMSI, callsign or name stands for in a period of ``days``.

    An IMO number is an identity. An MMSI belongs to the one IMO number it was seen with in the period, a callsign to
    the one identity told by IMO number or MMSI, a name to the one told by any of the three. An alias that was seen with
    two identities is ``ambiguous`` and stands for itself, as does one seen with none, so two IMO numbers are
    never one identity, whatever they share. Contacts without a time have the period NULL; repeated rows change nothing.
    """
    period = F.floor(F.unix_timestamp(at) / (days * 86_400)).cast("long").alias("period")
    kinds = ("imo", "mmsi", "callsign", "name")
    aliases = identity.route_aliases()

    def of(kind: str) -> Column:
        return F.get(F.filter(aliases, lambda a: a.startswith(kind + ":")), F.lit(0)).alias("_" + kind)

    of_kind = [of(k) for k in kinds]
    # Each step reads these rows several times, so they are written once a step.
    told = cut_lineage(contacts.select(period, *of_kind).distinct().withColumn("_identity", F.col("_imo")))
    owners = [told.where(F.col("_imo").isNotNull()).select(
        "period", F.col("_imo").alias("alias"), F.col("_imo").alias("canonical"), F.lit(False).alias("ambiguous")).distinct()]
    for kind in kinds[1:]:
        alias = F.col("_" + kind)
        seen = told.where(alias.isNotNull()).groupBy("period", alias.alias("alias")).agg(
            F.min("_identity").alias("_low"), F.max("_identity").alias("_high"))
        one = F.col("_low") == F.col("_high")
        owner = cut_lineage(seen.select("period", "alias", F.when(one, F.col("_low")).otherwise(F.col("alias")).alias("canonical"),
                                        F.coalesce(~one, F.lit(False)).alias("ambiguous")))
        owners.append(owner)
        if kind == kinds[-1]:
            break
        # Only rows that no stronger alias tells ask for the owner; a row without this alias meets nothing.
        asks = told.where(F.col("_identity").isNull() & alias.isNotNull())
        asked = asks.join(owner.select(F.col("period").alias("_p"), F.col("alias").alias("_a"), "canonical"),
                          F.col("period").eqNullSafe(F.col("_p")) & (alias == F.col("_a")), "left")
        told = cut_lineage(told.where(F.col("_identity").isNotNull() | alias.isNull()).unionByName(
            asked.withColumn("_identity", F.col("canonical")).select(*told.columns)))
    return reduce(DataFrame.unionByName, owners)
