"""History compaction, shards, budgets, sampling and route states."""

from pyspark.sql import functions as F

from wakeline.functions import identity
from wakeline.operators import history, route
from wakeline.queries import fragments as S
from wakeline.queries.fixtures import AS_OF
from wakeline.queries.registry import query

_IN = f"seen_at BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY AND TIMESTAMP '{AS_OF}' + INTERVAL 24 HOUR"
KEPT = f"""kp AS (SELECT *, row_number() OVER (PARTITION BY history_key ORDER BY seen_at DESC, event_id DESC) AS kn FROM v_history WHERE {_IN}),
kept AS (SELECT * FROM kp WHERE kn = 1)"""


def kept(t):
    return history.compact(t.history, "history_key", "seen_at", "event_id", t.as_of)


@query("win04_newest_per_key", """
SELECT history_key, arg_max(event_id, (seen_at, event_id)) AS event_id FROM v_history WHERE seen_at IS NOT NULL GROUP BY 1""")
def _(t):
    return history.newest_per_key(t.history.where("seen_at IS NOT NULL"), "history_key", "seen_at", "event_id").select("history_key", "event_id")


@query("str10_compaction", f"WITH {KEPT} SELECT history_key, event_id, epoch_us(seen_at) AS us FROM kept")
def _(t):
    return kept(t).select("history_key", "event_id", F.unix_micros("seen_at").alias("us"))


@query("str10_compaction_stats", f"""
SELECT count(*) AS source_rows, count(*) FILTER (seen_at IS NULL) AS missing_timestamp_rows, count(*) FILTER (seen_at < TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY) AS outside_window_rows,
 count(*) FILTER (seen_at > TIMESTAMP '{AS_OF}' + INTERVAL 24 HOUR) AS future_timestamp_rows, count(*) FILTER ({_IN}) - count(DISTINCT history_key) FILTER ({_IN}) AS duplicate_rows,
 count(DISTINCT history_key) FILTER ({_IN}) AS kept_rows FROM v_history""")
def _(t):
    return history.compact_stats(t.history, "history_key", "seen_at", t.as_of)


MAX_PART = 4000
# Some rows come near the limit: they are parts of their own and leave the others together.
BYTES = f"CASE WHEN event_id % 50 = 0 THEN {MAX_PART - 1} ELSE row_bytes END"
PARTS = f"""{KEPT}, pk AS (SELECT *, CAST(seen_at AS DATE) AS d, {BYTES} AS b FROM kept),
ps AS (SELECT *, sum(CASE WHEN b * 2 > {MAX_PART} THEN 0 ELSE b END) OVER w AS run, count(*) FILTER (b * 2 > {MAX_PART}) OVER w AS larges FROM pk WINDOW w AS (PARTITION BY d ORDER BY seen_at, history_key)),
pn AS (SELECT d, max(floor((run - b) * 2 / {MAX_PART})) + 1 AS smalls FROM ps WHERE b * 2 <= {MAX_PART} GROUP BY 1),
pt AS (SELECT ps.* EXCLUDE (row_bytes), b AS row_bytes, CAST(CASE WHEN b * 2 > {MAX_PART} THEN coalesce(smalls, 0) + larges ELSE floor((run - b) * 2 / {MAX_PART}) + 1 END AS INT) AS part FROM ps LEFT JOIN pn USING (d))"""


def parts(t):
    size = F.when(F.col("event_id") % 50 == 0, MAX_PART - 1).otherwise(F.col("row_bytes"))
    return history.assign_parts(kept(t), "seen_at", "history_key", size, MAX_PART)


@query("win10_day_shards", f"WITH {PARTS} SELECT event_id, CAST(d AS VARCHAR) AS date_utc, part FROM pt")
def _(t):
    return parts(t).select("event_id", F.col("date_utc").cast("string").alias("date_utc"), "part")


@query("agg17_shard_manifest", f"""
WITH {PARTS} SELECT CAST(d AS VARCHAR) AS date_utc, part, count(*) AS rows, sum(row_bytes)::BIGINT AS bytes, epoch_us(min(seen_at)) AS oldest, epoch_us(max(seen_at)) AS newest FROM pt GROUP BY ALL
UNION ALL SELECT NULL, NULL, count(*), sum(row_bytes)::BIGINT, epoch_us(min(seen_at)), epoch_us(max(seen_at)) FROM pt""")
def _(t):
    return history.shard_manifest(parts(t), "seen_at").select(
        F.col("date_utc").cast("string").alias("date_utc"), "part", "rows", "bytes", F.unix_micros("oldest").alias("oldest"),
        F.unix_micros("newest").alias("newest"))


@query("win12_newest_budget", f"""
WITH {KEPT}, r AS (SELECT event_id, sum(row_bytes) OVER (ORDER BY seen_at DESC, history_key DESC)::BIGINT AS running_bytes FROM kept) SELECT *, running_bytes <= 150000 AS within_limit FROM r""")
def _(t):
    return history.newest_within_budget(kept(t), "seen_at", "history_key", F.col("row_bytes"), 150000).select("event_id", "running_bytes", "within_limit")


@query("win13_size_trim", """
WITH r AS (SELECT event_id, sum(row_bytes) OVER (ORDER BY observed_at DESC, event_id DESC)::BIGINT AS running_bytes FROM v_contacts) SELECT *, running_bytes <= 200000 AS within_limit FROM r""")
def _(t):
    return history.newest_within_budget(t.contacts, "observed_at", "event_id", F.col("row_bytes"), 200000).select("event_id", "running_bytes", "within_limit")


#: Identity, place p of its n rows in time, and (m) the round of each middle place.
ORDERED = f"""WITH RECURSIVE {KEPT}, i AS (SELECT *, {S.ID_HISTORY} AS identity FROM kept), g AS (SELECT *, row_number() OVER (PARTITION BY identity ORDER BY seen_at, history_key) - 1 AS p, count(*) OVER (PARTITION BY identity) AS n FROM i),
iv(n, lo, hi, ord, k) AS (SELECT DISTINCT n, 1::BIGINT, n - 2, 0::BIGINT, '' FROM g WHERE n > 2
 UNION ALL SELECT n, CASE WHEN b = 0 THEN lo ELSE (lo + hi) // 2 + 1 END, CASE WHEN b = 0 THEN (lo + hi) // 2 - 1 ELSE hi END, ord + 1, k || b FROM iv, (VALUES (0), (1)) s(b)
 WHERE CASE WHEN b = 0 THEN lo <= (lo + hi) // 2 - 1 ELSE (lo + hi) // 2 + 1 <= hi END),
m AS (SELECT n, (lo + hi) // 2 AS p, row_number() OVER (PARTITION BY n ORDER BY ord, k) + 1 AS round FROM iv)"""
_ROUND = "CASE WHEN g.p = g.n - 1 THEN 0 WHEN g.p = 0 THEN 1 ELSE m.round END"


@query("win09_sampling_order", f"""
{ORDERED}
SELECT event_id, {_ROUND} AS round FROM g LEFT JOIN m ON m.n = g.n AND m.p = g.p""")
def _(t):
    rows = kept(t).withColumn("identity", identity.id_history())
    return history.sampling_order(rows, "identity", "seen_at", "history_key", "is_priority_voi").select("event_id", "round")


# The walk takes, again and again, the next row in order that still fits.
@query("win09_balanced_sample", f"""
{ORDERED},
gi AS (SELECT identity, max(seen_at) AS latest, bool_or(coalesce(is_priority_voi, false)) AS pri FROM i GROUP BY 1),
o AS (SELECT g.*, row_number() OVER (ORDER BY {_ROUND}, pri DESC, latest DESC, identity) AS place FROM g JOIN gi USING (identity) LEFT JOIN m ON m.n = g.n AND m.p = g.p),
w(place, room) AS (SELECT 0::BIGINT, 150000::BIGINT
 UNION ALL SELECT min(o.place), room - arg_min(o.row_bytes, o.place) FROM w JOIN o ON o.place > w.place AND o.row_bytes <= w.room GROUP BY room)
SELECT identity, history_key, event_id, place IN (SELECT place FROM w) AS sampled FROM o""")
def _(t):
    rows = kept(t).withColumn("identity", identity.id_history())
    return history.balanced_sample(rows, "identity", "seen_at", "history_key", "is_priority_voi", F.col("row_bytes"), 150000).select(
        "identity", "history_key", "event_id", "sampled")


@query("set04_subset_disjoint", f"""
WITH {KEPT} SELECT (SELECT count(*) FROM (SELECT DISTINCT history_key FROM v_history WHERE history_key NOT IN (SELECT history_key FROM kept))) AS missing,
 0::BIGINT AS overlapping""")
def _(t):
    k = kept(t)
    missing = history.subset_violations(t.history, k, "history_key").agg(F.count("*").alias("missing"))
    shared = history.disjoint_violations(parts(t), "history_key").agg(F.count("*")).scalar()
    return missing.withColumn("overlapping", shared)


@query("set09_validation", f"""
SELECT count(*) AS rows, count(*) FILTER (seen_at IS NULL) AS missing_timestamp, count(*) FILTER (seen_at < TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY - INTERVAL 5 MINUTE) AS outside_window,
 count(*) FILTER (seen_at > TIMESTAMP '{AS_OF}' + INTERVAL 24 HOUR) AS future, (SELECT count(*) FROM (SELECT history_key FROM v_history GROUP BY 1 HAVING count(*) > 1)) AS duplicate_keys FROM v_history""")
def _(t):
    return history.validate(t.history, "history_key", "seen_at", t.as_of)


@query("set09_validation_passes", f"""
WITH {KEPT} SELECT count(*) AS rows, true AS ok FROM kept""")
def _(t):
    return history.require_valid(history.validate(kept(t), "history_key", "seen_at", t.as_of)).select("rows", "ok")


# --- route states -----------------------------------------------------------------------

_W = "(PARTITION BY identity_key ORDER BY observed_at, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_WI = "(PARTITION BY identity_key ORDER BY observed_at, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
ROUTES = f"""r1 AS (SELECT *, coalesce(last_value(CASE WHEN destination IS NOT NULL THEN declared END IGNORE NULLS) OVER {_W}, false) AS was,
 last_value(destination IGNORE NULLS) OVER {_W} AS pdest, last_value(CASE WHEN port_seen THEN observed_at END IGNORE NULLS) OVER {_W} AS pport FROM v_voyages),
r2 AS (SELECT *, destination IS NOT NULL AND NOT declared AND was AS changed FROM r1),
r3 AS (SELECT *, last_value(CASE WHEN declared THEN TIMESTAMP '1900-01-01' WHEN changed THEN observed_at END IGNORE NULLS) OVER {_WI} AS lead_at FROM r2),
r4 AS (SELECT *, declared OR (was AND destination IS NULL) AS dec, coalesce(pport + INTERVAL 10 DAY >= observed_at, false) AS wasc, coalesce(lead_at + INTERVAL 10 DAY >= observed_at, false) AS running FROM r3),
rt AS (SELECT event_id, identity_key, observed_at, destination, dec AS to_russia_declared, NOT dec AND running AND NOT (wasc AND NOT port_seen) AS recent_unconfirmed, port_seen OR wasc AS recent_confirmed,
 declared AND (NOT was OR pdest IS DISTINCT FROM destination) AS declared_event, changed AS changed_event, port_seen AND NOT wasc AS confirmed_event FROM r4)"""
FLAGS = ("to_russia_declared", "recent_unconfirmed", "recent_confirmed", "declared_event", "changed_event", "confirmed_event")


def routes(t):
    return route.route_states(t.voyages, "identity_key", "observed_at", "event_id", "destination", "declared", "port_seen")


@query("str02_route_states", f"WITH {ROUTES} SELECT event_id, {', '.join(FLAGS)} FROM rt")
def _(t):
    return routes(t).select("event_id", *FLAGS)


_KINDS = ("to_russia_declared", "recent_russian_portcall_unconfirmed", "recent_russian_portcall_confirmed")


@query("str03_route_events", f"""
WITH {ROUTES}, e AS (SELECT *, unnest([x FOR x IN [CASE WHEN declared_event THEN '{_KINDS[0]}' END, CASE WHEN changed_event THEN '{_KINDS[1]}' END, CASE WHEN confirmed_event THEN '{_KINDS[2]}' END]
 IF x IS NOT NULL]) AS event_type FROM rt)
SELECT substr(sha256(concat_ws('|', identity_key, event_type, strftime(observed_at, '%Y-%m-%dT%H:%M:%S.%fZ'), coalesce(destination, ''), '')), 1, 24) AS event_id, event_type, identity_key FROM e""")
def _(t):
    return route.route_events(routes(t), "identity_key", "observed_at", "destination").select("event_id", "event_type", "identity_key")


@query("snk08_idempotent_events", f"""
WITH {ROUTES}, e AS (SELECT count(*) FILTER (declared_event) + count(*) FILTER (changed_event) + count(*) FILTER (confirmed_event) AS n FROM rt WHERE observed_at >= TIMESTAMP '2024-01-20') SELECT n AS new_events FROM e""")
def _(t):
    events = route.route_events(routes(t), "identity_key", "observed_at", "destination")
    log = events.where("event_at < TIMESTAMP '2024-01-20'")
    return route.new_events(events.unionByName(events), log).agg(F.count("*").alias("new_events"))


@query("str09_state_retention", f"""
SELECT mmsi, epoch_us(max(observed_at)) AS us FROM v_contacts GROUP BY 1 HAVING max(observed_at) >= TIMESTAMP '{AS_OF}' - INTERVAL 5 DAY""")
def _(t):
    state = t.contacts.groupBy("mmsi").agg(F.max("observed_at").alias("updated_at"))
    return route.retained(state, "updated_at", t.as_of, 5).select("mmsi", F.unix_micros("updated_at").alias("us"))


@query("str07_day_slots", """
SELECT strftime(observed_at, '%Y-%m-%dT') || CASE WHEN hour(observed_at) >= 20 THEN '20' WHEN hour(observed_at) >= 11 THEN '11' WHEN hour(observed_at) >= 5 THEN '05' ELSE '00' END || ':00:00Z' AS slot,
 count(*) AS n, count(DISTINCT mmsi) AS vessels FROM v_contacts GROUP BY 1""")
def _(t):
    from wakeline.functions.times import slot_label

    return t.contacts.groupBy(slot_label(F.col("observed_at")).alias("slot")).agg(F.count("*").alias("n"), F.count_distinct("mmsi").alias("vessels"))


