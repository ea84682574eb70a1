"""Current product: feeds to one classified row per vessel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions import identity
from wakeline.operators import classify as cl
from wakeline.operators import matching, merge
from wakeline.sources import sinks

FIELDS = ("mmsi", "imo", "callsign", "name", "latitude", "longitude", "destination", "last_port", "flag", "ship_type",
          "ship_type_text", "sog", "cog")


def current_vessels(contacts: DataFrame, watch: DataFrame, ports: DataFrame, flags: DataFrame,
                    order=("observed_at", "seq")) -> DataFrame:
    """Merge to one row per vessel first, so that matching and classification run on few rows."""
    merged = merge.newest_nonempty(contacts.withColumn("identity_key", identity.id_merge()), "identity_key", FIELDS,
                                   order, sources="provider")
    classified = cl.classify(merged, watch, matching.port_terms(ports), flags)
    return classified.select("identity_key", "mmsi", "imo", "name", "latitude", "longitude", "matched_on", "categories",
                             "flag_risk_band", "to_russia_declared", "from_russia_confirmed", "merged_rows")


def classified_snapshot(contacts: DataFrame, watch: DataFrame, ports: DataFrame, flags: DataFrame, recent: list[DataFrame],
                        seq: str, cap: P.TankerCap = P.TankerCap()) -> DataFrame:
    """Classified items, recent port-call items added where not live, neutral tankers capped."""
    live = cl.classify(contacts, watch, matching.port_terms(ports), flags).where(F.size("categories") > 0)
    both = merge.union_first_wins([live, *recent], identity.id_dedupe(), seq)
    neutral = F.array_contains("categories", "neutral_tanker_context")
    capped = cl.cap_neutral(both.withColumn("row_id", F.col(seq)).withColumn("last_seen", F.col("observed_at")),
                            cap=cap).where("within_limit").select(seq)
    return both.where(~neutral).unionByName(both.where(neutral).join(capped, seq, "left_semi"))


def publish(items: DataFrame, root: str) -> None:
    """Snapshot, one layer per category, statistics."""
    sinks.fan_out(items, root, tuple(P.CATEGORY_RANK), ("mmsi", "imo", "name", "categories"), cl.snapshot_counters(items))


def latest_positions(archive: DataFrame, known: DataFrame, key: str = "mmsi", at: str = "observed_at", seq: str = "seq"
                     ) -> DataFrame:
    """Daily archive records to the two latest positions of every known vessel.

    The known-category filter runs on one row per vessel, after the reduction.
    """
    two = merge.latest_two(archive, key, at, seq)
    one = merge.contact_with_positions(two, key, at, ("imo", "callsign", "name", "destination", "ship_type"),
                                       ("latitude", "longitude", "sog", "cog"))
    return matching.match_known(one, known)


def best_per_vessel(events: DataFrame, key: str, n: int | None = None) -> DataFrame:
    """Events with their ``rank`` within the vessel, elevated and near ones first; all of them unless ``n`` is given."""
    order = Window.partitionBy(key).orderBy((F.col("level") != "elevated").asc(), F.col("minimum_distance_nm").asc())
    ranked = events.withColumn("rank", F.row_number().over(order))
    return ranked if n is None else ranked.where(F.col("rank") <= n)
