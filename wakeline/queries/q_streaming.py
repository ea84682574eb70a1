"""Streaming jobs run to completion over the given tables."""

from pyspark.sql import functions as F

from wakeline.operators import route
from wakeline.queries import fragments as S
from wakeline.queries.fixtures import AS_OF, VIEWS
from wakeline.queries.q_history import FLAGS, ROUTES, routes
from wakeline.queries.q_merge import FIELDS, _newest
from wakeline.queries.q_sources import scratch
from wakeline.queries.registry import query
from wakeline.streaming import contacts as live
from wakeline.streaming.route_state import route_stream


def stream(t, view: str):
    """A view's table as a file stream."""
    table, columns, where = VIEWS["v_" + view]
    schema = t.table(table).schema
    rows = t.spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(t.folder)
    return (rows.where(where) if where else rows).selectExpr(*columns)


@query("str01_latest_contact_state", f"""
WITH o AS (SELECT *, {S.digits('mmsi')} AS id FROM v_contacts) SELECT id, {_newest('event_id')}, count(*) AS merged_rows FROM o GROUP BY 1""")
def _(t):
    from wakeline.functions.text import norm_digits

    path = scratch(t)
    merge = live.latest_contacts_into(path + "/out", "id", FIELDS, ("event_id",))
    rows = t.contacts.withColumn("id", norm_digits("mmsi"))
    # Two loads before the stream brings everything once more, the first of them twice: only versions count.
    merge(rows.where("event_id % 3 = 0"), -2)
    merge(rows.where("event_id % 3 = 0"), -2)
    merge(rows.where("event_id % 3 = 1"), -1)
    live.run_once(stream(t, "contacts").withColumn("id", norm_digits("mmsi")).where("event_id % 3 = 2"), path + "/cp", merge)
    return live.read_contacts(t.spark, path + "/out", "id", FIELDS).withColumns({"latitude": F.round("latitude", 6), "longitude": F.round("longitude", 6)})


# Arrival: slices of eight days; every third row of a slice's last two days comes with the next slice. A row is late
# if its identity has a newer one in an earlier slice. A lead of ten days ends where no declaration came before its
# end, once the identity is seen after it or the watermark (three days behind the newest row) has passed it.
_SLICE = "CAST(floor(({us} - 1704067200000000) / 691200000000) AS INT)"
_ARRIVAL = _SLICE.format(us="{us}") + " + CASE WHEN event_id % 3 = 0 AND " + _SLICE.format(us="{us} + 172800000000") + " > " + _SLICE.format(us="{us}") + " THEN 1 ELSE 0 END"
ARRIVED = f"""ar AS (SELECT *, epoch_us(observed_at) AS us, {_ARRIVAL.format(us='epoch_us(observed_at)')} AS slice FROM v_voyages),
newest AS (SELECT identity_key, slice, max(max(us)) OVER (PARTITION BY identity_key ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM ar GROUP BY 1, 2),
lt AS (SELECT ar.*, coalesce(us < seen, false) AS late FROM ar JOIN newest USING (identity_key, slice)),
intime AS (SELECT * FROM lt WHERE NOT late)"""


@query("str02_route_state_stream", f"""
WITH {ARRIVED}, {ROUTES.replace('FROM v_voyages', 'FROM intime')},
ends AS (SELECT identity_key, epoch_us(observed_at) + 864000000000 AS at_us FROM rt c WHERE changed_event AND NOT EXISTS (SELECT 1 FROM intime h WHERE h.identity_key = c.identity_key
  AND h.declared AND h.us > epoch_us(c.observed_at) AND h.us <= epoch_us(c.observed_at) + 864000000000))
SELECT identity_key, event_id, epoch_us(observed_at) AS at_us, {', '.join(FLAGS)}, false AS lead_ended, false AS late FROM rt
UNION ALL SELECT identity_key, event_id, us, {', '.join(['NULL'] * len(FLAGS))}, false, true FROM lt WHERE late
UNION ALL SELECT identity_key, NULL, at_us, {', '.join(['NULL'] * len(FLAGS))}, true, false FROM ends e
WHERE at_us < (SELECT max(us) FROM ar) - 259200000000 OR EXISTS (SELECT 1 FROM intime h WHERE h.identity_key = e.identity_key AND h.us > e.at_us)""")
def _(t):
    path = scratch(t)
    rows = t.voyages.select("identity_key", "event_id", "observed_at", F.col("destination").alias("place"), "declared", "port_seen")
    arrival = F.expr(_ARRIVAL.format(us="unix_micros(observed_at)"))
    for k in range(5):  # one file a slice, one slice a micro-batch
        rows.where(arrival == k).repartition(1).write.parquet(f"{path}/in/{k}")
    arriving = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path + "/in")
    with live.rocksdb(t.spark):
        live.run_to_files(route_stream(arriving, delay="3 days"), path + "/cp", path + "/out")
    return t.spark.read.parquet(path + "/out")


@query("str03_unique_event_stream", f"""
WITH {ROUTES} SELECT (SELECT count(*) FROM rt WHERE declared_event) + (SELECT count(*) FROM rt WHERE changed_event) + (SELECT count(*) FROM rt WHERE confirmed_event) AS events""")
def _(t):
    path = scratch(t)
    events = route.route_events(routes(t), "identity_key", "observed_at", "destination")
    # The log is written twice, as a restarted producer would.
    events.write.parquet(path + "/log/a")
    events.write.parquet(path + "/log/b")
    rows = t.spark.readStream.schema(events.schema).option("recursiveFileLookup", True).parquet(path + "/log")
    live.run_to_files(live.unique_events(rows, "event_at", delay="60 days"), path + "/cp", path + "/out")
    return t.spark.read.parquet(path + "/out").agg(F.count("*").alias("events"))


@query("str04_late_and_future", f"""
SELECT CASE WHEN seen_at IS NULL THEN 'missing_timestamp' WHEN seen_at < TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY THEN 'outside_window'
 WHEN seen_at > TIMESTAMP '{AS_OF}' + INTERVAL 24 HOUR THEN 'future_timestamp' ELSE 'kept' END AS reason, count(*) AS n FROM v_history GROUP BY 1
UNION ALL SELECT 'passed', count(*) FROM v_history WHERE seen_at BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY AND TIMESTAMP '{AS_OF}' + INTERVAL 24 HOUR""")
def _(t):
    path = scratch(t)
    rows = stream(t, "history")
    live.run_once(rows, path + "/cp1", live.reject_counter("seen_at", t.as_of, path + "/counts"))
    live.run_to_files(live.timely(rows, "seen_at", t.as_of), path + "/cp2", path + "/kept")
    counts = t.spark.read.parquet(path + "/counts").groupBy("reason").agg(F.sum("n").alias("n"))
    return counts.unionByName(t.spark.read.parquet(path + "/kept").agg(F.lit("passed").alias("reason"), F.count("*").alias("n")))


@query("str10_compaction_stream", f"""
WITH k AS (SELECT *, row_number() OVER (PARTITION BY history_key ORDER BY seen_at DESC, event_id DESC) AS n FROM v_history WHERE seen_at BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY
 AND TIMESTAMP '{AS_OF}' + INTERVAL 24 HOUR) SELECT history_key, event_id FROM k WHERE n = 1""")
def _(t):
    path = scratch(t)
    merge = live.compact_into(path + "/table", "history_key", "seen_at", "event_id", t.as_of)
    # A load of long ago, in its own time, then a newer one, then the whole stream merged into it.
    long_ago = t.history.where("event_id % 7 = 0").withColumn("seen_at", F.col("seen_at") - F.expr("INTERVAL 40 DAY")).withColumn(
        "history_key", F.concat(F.lit("old-"), "history_key"))
    live.compact_into(path + "/table", "history_key", "seen_at", "event_id", t.as_of - F.expr("INTERVAL 40 DAY"))(long_ago, -2)
    merge(t.history.where("event_id % 2 = 0"), -1)
    live.run_once(stream(t, "history"), path + "/cp", merge)
    return live.read_compacted(t.spark, path + "/table", "history_key", "seen_at", "event_id", t.as_of).select("history_key", "event_id")
