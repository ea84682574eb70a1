"""Timestamp parsing and the history-time cascades. All results are UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.functions.text import col, let, parse_float, present

_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([+-]\d{2}:?\d{2})?)?$"
EARLIEST = "2000-01-01 00:00:00"
SLOT_HOURS = (0, 5, 11, 20)


def parse_dt(value: Column | str) -> Column:
    """ISO text to timestamp: repairs UTC suffixes, cuts nanoseconds, bad text is NULL."""
    text = present(value)
    text = F.regexp_replace(text, r" \+0000 UTC$| UTC$|Z$", "+00:00")
    text = F.regexp_replace(text, r"(\.\d{6})\d+", "$1")
    return F.regexp_extract(text, _ISO, 0).try_cast("timestamp")


def parse_archive_dt(value: Column | str) -> Column:
    """``DD/MM/YYYY HH:MM:SS``, read as UTC."""
    return F.try_to_timestamp(present(value), F.lit("dd/MM/yyyy HH:mm:ss"))


def operational(value: Column, as_of: Column) -> Column:
    """The timestamp when it lies between 2000-01-01 and ``as_of`` plus a day, else NULL."""
    earliest = F.lit(EARLIEST).cast("timestamp")
    return let(value, lambda v: F.when((v >= earliest) & (v <= as_of + F.expr("INTERVAL 1 DAY")), v))


def normalize_timestamp(value: Column | str, fetched_at: Column, as_of: Column) -> tuple[Column, Column, Column]:
    """(timestamp, valid, basis): epoch seconds or milliseconds, ISO text, else retrieval time."""
    text = present(value)
    number = let(F.when(text.rlike(r"^\d+(\.\d*)?$|^\.\d+$"), parse_float(text)),
                 lambda n: F.when(n > 1e10, n / 1000.0).otherwise(n))
    seconds = let(number, lambda n: F.when(n < 1e11, F.timestamp_seconds(F.floor(n))))
    good = operational(F.coalesce(seconds, F.date_trunc("second", parse_dt(text))), as_of)
    return (
        F.coalesce(good, fetched_at),
        good.isNotNull(),
        F.when(good.isNotNull(), "source_timestamp").otherwise("retrieval_time_fallback"),
    )


def history_dt(last_seen, observed, port_date, generated, slot, key) -> Column:
    prefix = F.when(F.instr(col(key), "|") > 0, F.split_part(col(key), F.lit("|"), F.lit(1)))
    return F.coalesce(*[parse_dt(c) for c in (last_seen, observed, port_date, generated, slot)], parse_dt(prefix))


def fallback_history_dt(last_seen, declared_valid, declared_basis, key, snapshot_at: Column,
                        as_of: Column) -> tuple[Column, Column]:
    """(timestamp, basis): last seen, then the key's slot, then the snapshot time."""
    raw = operational(parse_dt(last_seen), as_of)
    prefix = F.when(F.instr(col(key), "|") > 0, F.split_part(col(key), F.lit("|"), F.lit(1)))
    slot = operational(parse_dt(prefix), as_of)
    snapshot = operational(snapshot_at, as_of)
    declared = F.coalesce(present(declared_basis), F.when(
        F.coalesce(col(declared_valid), F.lit(True)), "source_timestamp").otherwise("retrieval_time_fallback"))
    basis = (F.when(raw.isNotNull(), declared)
             .when(slot.isNotNull(), "history_slot_fallback")
             .when(snapshot.isNotNull(), "snapshot_generated_at_fallback")
             .otherwise("missing_or_invalid"))
    return F.coalesce(raw, slot, snapshot), basis


def slot_of(as_of: Column) -> Column:
    """Floor to the day's 00, 05, 11 or 20 o'clock slot."""
    hour = F.hour(as_of)
    start = F.lit(SLOT_HOURS[0])
    for h in SLOT_HOURS[1:]:
        start = F.when(hour >= h, h).otherwise(start)
    return F.timestamp_seconds(F.unix_seconds(F.date_trunc("day", as_of)) + start * 3600)


def slot_label(as_of: Column) -> Column:
    return F.date_format(slot_of(as_of), "yyyy-MM-dd'T'HH:00:00'Z'")


def iso_z(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def micros(value: Column) -> Column:
    return F.unix_micros(value.cast("timestamp"))


def minutes_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / 60e6


def time_chunk(value: Column, seconds: int) -> Column:
    """Ordered chunk number of a timestamp; used to split busy keys over many tasks."""
    return F.floor(micros(value) / F.lit(seconds * 1_000_000)).cast("bigint")
