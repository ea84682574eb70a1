"""The six identity keys. They disagree on purpose; each job names the one it uses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.functions.text import col, collapse, norm_digits, norm_text, present


def _tag(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix + ":"), value)


def _sized(value: Column, size: int) -> Column:
    return F.when(F.length(value) == size, value)


def id_merge(mmsi="mmsi", imo="imo", callsign="callsign", name="name") -> Column:
    return F.coalesce(_tag("mmsi", norm_digits(mmsi)), _tag("imo", norm_digits(imo)),
                      _tag("callsign", norm_text(callsign)), _tag("name", norm_text(name)))


def id_dedupe(mmsi="mmsi", imo="imo", callsign="callsign", name="name") -> Column:
    return F.coalesce(norm_digits(imo), norm_digits(mmsi), norm_text(callsign), norm_text(name))


def id_common(mmsi="mmsi", imo="imo", callsign="callsign", name="name", existing=None) -> Column:
    keys = [_tag("imo", _sized(norm_digits(imo), 7)), _tag("mmsi", _sized(norm_digits(mmsi), 9)),
            _tag("callsign", norm_text(callsign)), _tag("name", norm_text(name))]
    if existing is not None:
        keys.insert(0, collapse(existing))
    return F.coalesce(*keys)


def id_track(mmsi="mmsi", imo="imo", callsign="callsign", name="name") -> Column:
    fields = (("mmsi", mmsi), ("imo", imo), ("callsign", callsign), ("name", name))
    return F.coalesce(*[_tag(tag, F.upper(present(value))) for tag, value in fields])


def id_history(key="history_key", mmsi="mmsi", imo="imo", callsign="callsign", name="name") -> Column:
    def usable(value):
        text = F.lower(collapse(value))
        return F.when(~text.isin("0", "unknown", "none", "null", "n/a"), text)

    fields = (("mmsi", mmsi), ("imo", imo), ("callsign", callsign), ("name", name))
    return F.coalesce(*[_tag(tag, usable(value)) for tag, value in fields], _tag("row", col(key)))


def id_grid(mmsi="mmsi", imo="imo", vessel_id="vessel_id") -> Column:
    return F.coalesce(_tag("imo", _sized(norm_digits(imo), 7)), _tag("mmsi", _sized(norm_digits(mmsi), 9)),
                      _tag("gfw", present(vessel_id)))


def route_aliases(mmsi="mmsi", imo="imo", callsign="callsign", name="name") -> Column:
    """All identity keys a contact carries, strongest first."""
    return F.array_compact(F.array(
        _tag("imo", _sized(norm_digits(imo), 7)), _tag("mmsi", _sized(norm_digits(mmsi), 9)),
        _tag("callsign", norm_text(callsign)), _tag("name", norm_text(name))))
