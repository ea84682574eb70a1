"""The route-state stream over several micro-batches: late rows, leads that end by timer, identities that leave."""

import datetime as dt

from wakeline.streaming import contacts as live
from wakeline.streaming.route_state import route_stream

START = dt.datetime(2026, 1, 1)
SCHEMA = "identity_key string, event_id long, observed_at timestamp, place string, declared boolean, port_seen boolean"


def run(spark, folder, *batches):
    for k, rows in enumerate(batches):
        made = [(key, n, START + dt.timedelta(days=day), place, declared, False) for key, n, day, place, declared in rows]
        spark.createDataFrame(made, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{k}")
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{folder}/in")
    with live.rocksdb(spark):
        query = live.run_to_files(route_stream(rows, delay="1 day"), f"{folder}/cp", f"{folder}/out")
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == len(batches)
    return spark.read.parquet(f"{folder}/out").collect()


def day_of(row):
    return (row.at_us - int(START.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)) / 86400e6


def test_leads_end_by_timer_by_row_or_not_at_all(spark, tmp_path):
    out = run(spark, tmp_path,
              [(key, 10 * k + j, j, *said) for k, key in enumerate("abc") for j, said in enumerate([("RU LED", True), ("DEHAM", False)])],
              [("b", 19, 8.0, "RU LED", True), ("c", 29, 14.0, None, False), ("z", 1, 14.0, None, False)],
              [("a", 30, 0.5, "DEHAM", False), ("z", 2, 20.0, None, False)])
    # a is not seen again: its lead ends by timer; that of b is taken back by a declaration; that of c ends with its next row.
    assert sorted((r.identity_key, day_of(r)) for r in out if r.lead_ended) == [("a", 11.0), ("c", 11.0)]
    assert len(out) == 11 + 2 and [r.event_id for r in out if r.late] == [30]


def test_rows_older_than_the_state_are_late(spark, tmp_path):
    out = run(spark, tmp_path, [("a", 2, 5.0, "RU LED", True), ("a", 1, 4.0, None, False)], [("a", 3, 4.5, "DEHAM", False), ("a", 4, 5.0, "DEHAM", False)])
    assert {(r.event_id, r.late, r.changed_event) for r in out} == {(1, False, False), (2, False, False), (3, True, None), (4, False, True)}


def test_identities_leave_after_120_days(spark, tmp_path):
    out = run(spark, tmp_path, [("a", 1, 0.0, "RU LED", True)], [("z", 2, 130.0, None, False)], [("z", 3, 140.0, None, False)], [("a", 4, 141.0, None, False)])
    again = [r for r in out if r.event_id == 4]
    assert len(again) == 1 and not again[0].to_russia_declared  # its declaration left with its state
