"""Tests for the findings of round 4 that were right."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from wakeline.operators import keyed, radar

T0 = dt.datetime(2024, 1, 1)
GRID = ("region_id string, ais_matched boolean, observed_at timestamp, vessel_id string, latitude double, longitude double, "
        "imo string, mmsi string, watchlist_match boolean")
LIMIT = 60 * 24 * 20


def grid(spark, n=900, vessels=7, seed=3):
    """Few vessels, regions, times and places, so that times tie and places repeat; some values are missing."""
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        vessel = None if r.random() < 0.1 else f"v{int(vessels * r.random() ** 2)}"
        matched = None if r.random() < 0.05 else r.random() < 0.5
        region = None if r.random() < 0.1 else r.choice("ABC") if matched else r.choice("CD")
        at = None if r.random() < 0.05 else T0 + dt.timedelta(hours=12 * r.randrange(500))
        rows.append((region, matched, at, vessel, 54 + r.randrange(3) / 100, 8 + r.randrange(3) / 10, "", "", False))
    return spark.createDataFrame(rows, GRID)


def sides(rows, more_than):
    rows = radar.in_chunks(rows, more_than=more_than)
    sar = radar.grid_records(rows, "sar_", together="vessel_id")
    ais = radar.grid_records(rows.where("NOT ais_matched AND vessel_id IS NOT NULL"), "ais_",
                             ("region_id", "vessel_id", "observed_at", "lat5", "lon5"), together="vessel_id")
    return sar, ais


def expected(sar, ais, chosen):
    """Every record with every presence row of its vessel."""
    def nm(a, b):
        p1, p2 = math.radians(a.latitude), math.radians(b.latitude)
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b.longitude - a.longitude) / 2) ** 2
        return 3440.065 * 2 * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h)))

    out = {}
    for s in sar:
        if s.ais_matched is False:
            out[s.id] = ("not_applicable_ais_unmatched", None, None)
        elif not s.ais_matched or s.vessel_id not in chosen:
            out[s.id] = ("not_requested_identity_cap", None, None)
        else:
            rows = [a for a in ais if a.vessel_id == s.vessel_id]
            rows = [a for a in rows if a.region_id == s.region_id and s.region_id] or rows
            best = min(((abs((a.observed_at - s.observed_at).total_seconds()) / 60, round(nm(s, a), 6), a.id) for a in rows),
                       default=None)
            if best and best[0] <= LIMIT:
                out[s.id] = ("time_aligned_same_identity", best[2], best[0])
            else:
                out[s.id] = ("requested_but_no_time_aligned_context", None, None)
    return out


@pytest.mark.parametrize("more_than", (10 ** 6, 40, 0))
def test_correlation_finds_what_all_pairs_find(spark, more_than):
    rows = grid(spark)
    sar, ais = sides(rows, more_than)
    assert (radar.PART in sar.columns) == (more_than < 900)
    chosen = rows.where("vessel_id <> 'v1'").select("vessel_id")  # repeated, as selections may be
    got = radar.correlate(sar, ais, chosen, LIMIT).collect()
    plain = lambda t: t.select("id", "region_id", "ais_matched", "vessel_id", "observed_at", "latitude", "longitude").collect()
    want = expected(plain(sar), plain(ais), {f"v{i}" for i in range(7)} - {"v1"})
    assert len(got) == len(want) > 700
    assert {g.id: (g.correlation_status, g.ais_context_id, g.time_delta_minutes) for g in got} == want
    assert len({g.correlation_status for g in got}) == 4


def test_correlation_shuffles_each_record_once(spark, tmp_path):
    grid(spark).write.parquet(str(tmp_path) + "/g")
    rows = spark.read.parquet(str(tmp_path) + "/g")
    sar, ais = sides(rows, 10 ** 6)
    out = radar.correlate(sar, ais, radar.select_context_ids(radar.valid_grid(rows)), LIMIT)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # The records that ask, those that do not, the presence rows, and twice the list of selected vessels.
    assert plan.count("Exchange hashpartitioning") == 5 and "Join" not in plan


def test_carry_around_in_one_chunk_and_in_several(spark):
    r = random.Random(2)
    data = [(k, t, r.choice((None, t))) for k in ("a", "b", None) for t in range(60)]
    df = spark.createDataFrame(data, "k string, t int, v int")
    want = {(k, t): (max((x for j, x, v in data if j == k and v is not None and x <= t), default=None),
                     min((x for j, x, v in data if j == k and v is not None and x > t), default=None)) for k, t, _ in data}
    some = F.when(F.col("k") == "a", F.floor(F.col("t") / 7).cast("bigint"))
    for chunk in (None, F.floor(F.col("t") / 7).cast("bigint"), some):
        got = keyed.carry_around(df, ["k"], chunk, ["t"], F.col("v"), "b", "a").collect()
        assert {(g.k, g.t): (g.b, g.a) for g in got} == want
