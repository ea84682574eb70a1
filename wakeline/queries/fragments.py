"""SQL fragments the checks share (DuckDB dialect)."""

from __future__ import annotations

from wakeline import params as P


def present(x: str) -> str:
    return rf"nullif(regexp_replace({x}, '^\s+|\s+$', '', 'g'), '')"


def norm_text(x: str) -> str:
    return rf"regexp_replace(upper({present(x)}), '\s+', ' ', 'g')"


def norm_key(x: str) -> str:
    return f"nullif(regexp_replace(upper({x}), '[^A-Z0-9]', '', 'g'), '')"


def digits(x: str) -> str:
    return f"nullif(regexp_replace({x}, '[^0-9]', '', 'g'), '')"


def sized(x: str, n: int) -> str:
    return f"CASE WHEN length({digits(x)}) = {n} THEN {digits(x)} END"


ID_MERGE = (f"coalesce('mmsi:' || {digits('mmsi')}, 'imo:' || {digits('imo')}, 'callsign:' || {norm_text('callsign')}, "
            f"'name:' || {norm_text('name')})")
ID_COMMON = (f"coalesce('imo:' || {sized('imo', 7)}, 'mmsi:' || {sized('mmsi', 9)}, 'callsign:' || "
             f"{norm_text('callsign')}, 'name:' || {norm_text('name')})")
ID_DEDUPE = f"coalesce({digits('imo')}, {digits('mmsi')}, {norm_text('callsign')}, {norm_text('name')})"
ID_TRACK = (f"coalesce('mmsi:' || upper({present('mmsi')}), 'imo:' || upper({present('imo')}), 'callsign:' || "
            f"upper({present('callsign')}), 'name:' || upper({present('name')}))")


def usable(x: str) -> str:
    text = rf"lower(regexp_replace({present(x)}, '\s+', ' ', 'g'))"
    return f"CASE WHEN {text} NOT IN ('0', 'unknown', 'none', 'null', 'n/a') THEN {text} END"


ID_HISTORY = (f"coalesce('mmsi:' || {usable('mmsi')}, 'imo:' || {usable('imo')}, 'callsign:' || {usable('callsign')}, "
              f"'name:' || {usable('name')}, 'row:' || history_key)")


def haversine_nm(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    a = (f"(pow(sin((radians({lat2}) - radians({lat1})) / 2e0), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin((radians({lon2}) - radians({lon1})) / 2e0), 2))")
    return f"({P.EARTH_RADIUS_NM} * 2e0 * atan2(sqrt({a}), sqrt(greatest(0e0, 1e0 - {a}))))"


def haversine_m(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    a = (f"(pow(sin((radians({lat2}) - radians({lat1})) / 2e0), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin((radians({lon2}) - radians({lon1})) / 2e0), 2))")
    return f"({P.EARTH_RADIUS_M} * 2e0 * asin(least(1e0, sqrt({a}))))"


def fmod(x: str, base: str) -> str:
    return f"(({x}) - {base} * floor(({x}) / {base}))"


def bearing(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    dl = f"(radians({lon2}) - radians({lon1}))"
    y = f"sin({dl}) * cos(radians({lat2}))"
    x = f"cos(radians({lat1})) * sin(radians({lat2})) - sin(radians({lat1})) * cos(radians({lat2})) * cos({dl})"
    return fmod(f"degrees(atan2({y}, {x})) + 36e1", "36e1")


def segment_nm(lon: str, lat: str, a_lon: str, a_lat: str, b_lon: str, b_lat: str) -> str:
    """Distance to a segment, as nested SQL (arguments are repeated, keep them short)."""
    ax = f"(({a_lon} - {lon}) * 6e1 * cos(radians(({a_lat} + {lat}) / 2e0)))"
    ay = f"(({a_lat} - {lat}) * 6e1)"
    bx = f"(({b_lon} - {lon}) * 6e1 * cos(radians(({b_lat} + {lat}) / 2e0)))"
    by = f"(({b_lat} - {lat}) * 6e1)"
    vx, vy = f"({bx} - {ax})", f"({by} - {ay})"
    l2 = f"({vx} * {vx} + {vy} * {vy})"
    t = f"greatest(0e0, least(1e0, -({ax} * {vx} + {ay} * {vy}) / {l2}))"
    far = f"sqrt(({ax} + {t} * {vx}) * ({ax} + {t} * {vx}) + ({ay} + {t} * {vy}) * ({ay} + {t} * {vy}))"
    return f"CASE WHEN {l2} <= 1e-12 THEN sqrt({ax} * {ax} + {ay} * {ay}) ELSE {far} END"


def quoted(words) -> str:
    return ", ".join("'" + w + "'" for w in words)


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


TANKER = ("(ship_type BETWEEN 80 AND 89 OR coalesce(regexp_matches(" + norm_text("concat_ws(' ', " + present(
    "ship_type_text") + ", " + present("destination") + ")") + ", '" + P.TANKER_PATTERN + "'), false))")

ZONE_VALUES = ", ".join(f"('{z}', {s}e0, {n}e0, {w}e0, {e}e0)" for z, _l, s, n, w, e in P.TANKER_ZONES)
GATEWAY = " OR ".join(f"(latitude BETWEEN {s}e0 AND {n}e0 AND longitude BETWEEN {w}e0 AND {e}e0)"
                      for s, n, w, e in P.GATEWAY_BOXES)
