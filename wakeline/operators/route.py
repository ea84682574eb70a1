"""Destination and port-call states of a vessel, as ordered carries over its history.

This is the batch twin of the streaming state machine. What the machine remembers is always
"the last row that ...": the last non-empty destination (declared or not), the last change away
from a declaration, the last observed port. Each is one carry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.records import event_id
from wakeline.functions.text import norm_key
from wakeline.functions.times import time_chunk
from wakeline.operators.keyed import carry_last

LEAD_DAYS = 10


def route_states(rows: DataFrame, key: str, at: str, seq: str, destination: str, declared_hits: str, port_hits: str,
                 chunk_seconds: int = 86400, lead_days: int = LEAD_DAYS) -> DataFrame:
    """Rows with state flags and the event each one raises.

    ``destination``: text or NULL; ``declared_hits`` and ``port_hits``: booleans.
    """
    chunk = time_chunk(F.col(at), chunk_seconds)
    order = [at, seq]
    hit, port, dest = F.col(declared_hits), F.col(port_hits), F.col(destination)
    spoken = F.struct(F.col(at).alias("at"), hit.alias("declared"), norm_key(dest).alias("place"))
    df = carry_last(rows, [key], chunk, order, {
        "last_dest": F.when(dest.isNotNull(), spoken),
        "last_port_at": F.when(port, F.col(at))}, inclusive=False)
    was = F.coalesce(F.col("last_dest.declared"), F.lit(False))
    changed = dest.isNotNull() & ~hit & was
    # A new declaration clears the running lead, a change away from one starts it.
    mark = F.when(hit, F.struct(F.lit(None).cast("timestamp").alias("at"))).when(
        changed, F.struct(F.col(at).alias("at")))
    df = carry_last(df.withColumn("_mark", mark), [key], chunk, order, {"lead": F.col("_mark")})
    lead = F.make_dt_interval(F.lit(lead_days))
    running = F.col("lead.at").isNotNull() & (F.col("lead.at") + lead >= F.col(at))
    declared = hit | (was & dest.isNull())
    was_confirmed = F.coalesce(F.col("last_port_at") + lead >= F.col(at), F.lit(False))
    confirmed = port | was_confirmed
    unconfirmed = ~declared & F.coalesce(running, F.lit(False))
    # A port observed on this row overrides the confidence; a persisted one also clears the lead flag.
    basis = (F.when(port, "observed_port_field").when(was_confirmed, "persisted_observed_port_field")
             .when(hit, "current_ais_destination")
             .when(unconfirmed, "destination_changed_after_russian_destination")
             .when(declared, "last_observed_russian_destination"))
    df = (df.withColumn("to_russia_declared", declared)
          .withColumn("recent_unconfirmed", unconfirmed & ~(was_confirmed & ~port))
          .withColumn("recent_confirmed", confirmed).withColumn("route_basis", basis)
          .withColumn("declared_event", hit & (~was | ~F.col("last_dest.place").eqNullSafe(norm_key(dest))))
          .withColumn("changed_event", changed).withColumn("confirmed_event", port & ~was_confirmed))
    return df.drop("_mark", "lead", "last_dest", "last_port_at")


EVENTS = {
    "to_russia_declared": ("declared_event", "declared", "current_ais_destination"),
    "recent_russian_portcall_unconfirmed": ("changed_event", "unconfirmed",
                                            "destination_changed_after_russian_destination"),
    "recent_russian_portcall_confirmed": ("confirmed_event", "confirmed", "observed_port_field"),
}


def route_events(states: DataFrame, key: str, at: str, destination: str, hits: Column | None = None) -> DataFrame:
    """Append-only events with hashed ids."""
    kinds = F.array_compact(F.array(*[
        F.when(F.col(flag), F.struct(F.lit(kind).alias("event_type"), F.lit(conf).alias("confidence"),
                                     F.lit(basis).alias("basis")))
        for kind, (flag, conf, basis) in EVENTS.items()]))
    out = states.withColumn("_e", F.explode(kinds))
    when = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    text = F.array_join(hits, ",") if hits is not None else F.lit("")
    return out.select(
        event_id(F.col(key), F.col("_e.event_type"), when, F.coalesce(destination, F.lit("")), text).alias("event_id"),
        F.col("_e.event_type").alias("event_type"), F.col(at).alias("event_at"), F.col(key), F.col(destination),
        F.col("_e.confidence").alias("confidence"), F.col("_e.basis").alias("basis"))


def new_events(events: DataFrame, log: DataFrame) -> DataFrame:
    """Events whose id the log does not hold yet, each once."""
    return events.dropDuplicates(["event_id"]).join(log.select("event_id"), "event_id", "left_anti")


def retained(states: DataFrame, updated_at: str, as_of: Column, days: int = 120) -> DataFrame:
    return states.where(F.coalesce(F.col(updated_at), as_of) >= as_of - F.make_dt_interval(F.lit(days)))
