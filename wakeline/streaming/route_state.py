"""The destination and port-call state machine as a keyed streaming operator.

One state row per identity. Rows of a key are applied in event-time order, one bounded chunk of a micro-batch
after the other; rows older than the state change nothing and are passed on, marked late. The end of a lead is
an output of its own: with the first later row of the identity, or by a timer once the watermark has passed it.
A second timer removes identities that were not seen for 120 days. ``operators.route`` is the batch twin.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wakeline.functions.text import norm_key

OUTPUT = ("identity_key string, event_id bigint, at_us bigint, to_russia_declared boolean, recent_unconfirmed boolean, "
          "recent_confirmed boolean, declared_event boolean, changed_event boolean, confirmed_event boolean, "
          "lead_ended boolean, late boolean")
COLUMNS = [c.split()[0] for c in OUTPUT.split(", ")]
USED = ["at_us", "event_id", "place", "declared", "port_seen"]
STATE = "declared boolean, place string, lead_until bigint, confirmed_until bigint, updated_at bigint, removal_ms bigint"
LEAD_US = 10 * 86400 * 1_000_000
RETENTION_MS = 120 * 86400 * 1000


def step(state: tuple, at: int, place: str | None, hit: bool, port: bool) -> tuple[tuple, tuple]:
    """One observation: (new state, flags). Times are microseconds; ``place`` is None without destination."""
    was, last_place, lead_until, confirmed_until, _ = state
    changed = place is not None and not hit and was
    declared_event = hit and (not was or place != last_place)
    if hit:
        was, last_place, lead_until = True, place, 0
    elif changed:
        was, lead_until = False, at + LEAD_US
    was_confirmed = confirmed_until >= at
    if port:
        confirmed_until = at + LEAD_US
    unconfirmed = not was and lead_until >= at and not (was_confirmed and not port)
    flags = (was, unconfirmed, port or was_confirmed, declared_event, changed, port and not was_confirmed)
    return (was, last_place, lead_until, confirmed_until, at), flags


def timer_ms(lead_until: int) -> int:
    """The first millisecond after the last microsecond of a lead."""
    return lead_until // 1000 + 1


class RouteProcessor(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("route", STATE)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        *current, removal = self.state.get() or (False, None, 0, 0, 0, 0)  # one call: None is what a new key has
        current, lead = tuple(current), current[2]
        for chunk in rows:  # Arrow's batch size bounds a chunk, whatever the key has in the micro-batch
            out = []
            # Most chunks have few rows: plain lists cost a fraction of a sorted frame.
            for at, event, place, declared, port in sorted(zip(*[chunk[c].tolist() for c in USED]), key=itemgetter(0, 1)):
                if at < current[4]:
                    out.append((key[0], event, at, *[None] * 6, False, True))
                    continue
                if 0 < current[2] < at:
                    out.append(lead_end(key[0], current[2]))
                    current = (*current[:2], 0, *current[3:])
                current, flags = step(current, at, None if pd.isna(place) else place, bool(declared), bool(port))
                out.append((key[0], event, at, *flags, False, False))
            yield pd.DataFrame(out, columns=COLUMNS)
        if current[2] != lead:
            if lead:
                self.handle.deleteTimer(timer_ms(lead))
            if current[2]:
                self.handle.registerTimer(timer_ms(current[2]))
        if not removal:  # one timer a key: when it comes, a key seen since then gets the next one
            removal = current[4] // 1000 + RETENTION_MS
            self.handle.registerTimer(removal)
        self.state.update((*current, removal))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self.state.get()
        if known is None:
            return
        *current, removal = known
        now = expiredTimerInfo.getExpiryTimeInMs()
        if current[2] and timer_ms(current[2]) <= now:
            yield pd.DataFrame([lead_end(key[0], current[2])], columns=COLUMNS)
            current[2] = 0
        if removal <= now:
            removal = current[4] // 1000 + RETENTION_MS
            if removal <= now:
                self.state.clear()
                return
            self.handle.registerTimer(removal)
        self.state.update((*current, removal))


def lead_end(key: str, at: int) -> tuple:
    return (key, None, at, *[None] * 6, True, False)


def route_stream(rows: DataFrame, at: str = "observed_at", delay: str = "1 day") -> DataFrame:
    """Rows: identity_key, event_id, place, declared, port_seen and the event time. Needs the RocksDB state store.

    Destinations are compared in normal form, as the batch twin does. Rows of one micro-batch are applied in order
    of time as far as one chunk reaches, so a source should bound its batches (``maxFilesPerTrigger``). Output:
    one row for each row, and one with ``lead_ended`` (without event) for each lead that ran out.
    """
    timed = rows.withColumn("place", norm_key("place")).withWatermark(at, delay).withColumn("at_us", F.unix_micros(at))
    return timed.groupBy("identity_key").transformWithStateInPandas(
        RouteProcessor(), outputStructType=OUTPUT, outputMode="append", timeMode="EventTime")
