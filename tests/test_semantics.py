"""Rules on small literal inputs, and the chunked helpers against brute force."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions.tables import fixed_table
from wakeline.operators import filters, graph, history, keyed, matching, merge, proximity, radar, raster, review, snapshot
from wakeline.operators import spatial as sp
from wakeline.sources import sinks
from wakeline.streaming.route_state import step


def ts(text):
    return dt.datetime.fromisoformat(text)


def test_as_of_pick_takes_latest_before_and_keeps_previous(spark):
    rows = spark.createDataFrame([(i, "fintraffic", "mmsi:1", ts(t), lat, 24.0) for i, (t, lat) in enumerate(
        [("2026-07-21T02:00:00", 60.0), ("2026-07-21T11:30:00", 61.0), ("2026-07-21T13:00:00", 62.0)])],
        "seq int, provider string, identity_key string, observed_at timestamp, latitude double, longitude double")
    out = snapshot.pick_as_of(rows, F.lit("2026-07-21 12:00:00").cast("timestamp"), F.lit(16.0), "observed_at", "seq").collect()
    assert [(r.latitude, r.age_at_snapshot_minutes, r.previous_position.latitude) for r in out] == [(61.0, 30.0, 60.0)]


def test_canonical_prefers_exact_and_age_zero(spark):
    cols = "identity_key string, provider string, age_at_snapshot_minutes double, timestamp_valid boolean, position_is_exact boolean"
    rows = spark.createDataFrame([("a", "global_fishing_watch", 30.0, True, False), ("a", "barentswatch", 30.0, True, True),
                                  ("b", "barentswatch", 30.0, True, True), ("b", "fintraffic", 0.0, True, True)], cols)
    got = {r.identity_key: r.provider for r in snapshot.canonical(rows).collect()}
    assert got == {"a": "barentswatch", "b": "fintraffic"}


def test_archive_reject_reasons(spark):
    base = dict.fromkeys(P.ARCHIVE_COLUMNS, "")
    good = {**base, "timestamp": "16/08/2026 05:00:00", "type_of_mobile": "Class  A", "mmsi": "123456789", "latitude": "54.5", "longitude": "12"}
    cases = [("kept", {}), ("header", {"timestamp": "Timestamp"}), ("non_vessel_mobile_type", {"type_of_mobile": "Base Station"}),
             ("invalid_mmsi", {"mmsi": "12345678"}), ("invalid_timestamp", {"timestamp": "2026-08-16"}),
             ("invalid_position", {"latitude": "0", "longitude": "0"}), ("invalid_position", {"latitude": "nan"})]
    rows = spark.createDataFrame([(n, *{**good, **c}.values()) for n, c in cases], ["want", *good])
    out = rows.select("want", F.coalesce(filters.archive_reject_reason(), F.lit("kept")).alias("got")).collect()
    assert all(r.want == r.got for r in out)


@pytest.mark.parametrize("obs,method,quality,lon", [
    ([("05:24:02", 12.1, 5.0, 90.0)], "EXACT_ARCHIVE_OBSERVATION", "HIGH", 12.1),
    ([("05:19:02", 12.0, 1.0, 90.0), ("05:29:02", 12.002, 1.0, 90.0)], "LINEAR_INTERPOLATION_BRACKETED", "HIGH", 12.001),
    ([("05:23:02", 12.0, 10.0, 90.0)], "SOG_COG_EXTRAPOLATION_SINGLE_SIDED", "MEDIUM", None),
    ([("05:23:02", 12.0, None, None)], "NEAREST_OBSERVATION_NO_MOTION_MODEL", "LOW", 12.0)])
def test_projection_ladder(spark, obs, method, quality, lon):
    scene = F.lit("2026-08-16 05:24:02").cast("timestamp")
    rows = spark.createDataFrame([(i, "1", ts(f"2026-08-16T{t}"), x, 54.5, s, c) for i, (t, x, s, c) in enumerate(obs)],
                                 "seq int, mmsi string, observed_at timestamp, longitude double, latitude double, sog double, cog double")
    r = radar.project_tracks(snapshot.bracketing(rows, scene, "mmsi", "observed_at", F.lit(1), "seq"), scene).first()
    assert (r.projection_method, r.projection_quality) == (method, quality)
    if lon is None:
        assert r.motion_distance_m == pytest.approx(308.67, abs=0.01)
    else:
        assert r.projected_longitude == pytest.approx(lon, abs=1e-6)


def test_match_states(spark):
    det = fixed_table(spark, ("detection_id", "longitude", "latitude", "span_x_m", "span_y_m"), [
        ("MATCHED", 12.0, 54.5, 0.0, 0.0), ("POSSIBLE", 12.1, 54.5, 0.0, 0.0), ("AMB-A", 12.2, 54.6, 0.0, 0.0),
        ("AMB-B", 12.202, 54.6, 0.0, 0.0), ("UNMATCHED", 11.96, 54.65, 0.0, 0.0)])
    proj = fixed_table(spark, ("mmsi", "projected_longitude", "projected_latitude", "projection_method", "projection_quality",
                               "motion_distance_m"), [("111111111", 12.001, 54.5, "EXACT_ARCHIVE_OBSERVATION", "HIGH", 0.0),
                                                      ("222222222", 12.1, 54.5 + 1500 / 111194.9, "EXACT_ARCHIVE_OBSERVATION", "HIGH", 0.0),
                                                      ("333333333", 12.201, 54.6, "EXACT_ARCHIVE_OBSERVATION", "HIGH", 0.0)])
    pairs = radar.candidate_pairs(det, proj)
    for enough, want in ((True, ["AMBIGUOUS", "AMBIGUOUS", "MATCHED", "POSSIBLE_MATCH", "UNMATCHED_IN_AVAILABLE_AIS"]),
                         (False, ["AMBIGUOUS", "AMBIGUOUS", "POSSIBLE_MATCH", "POSSIBLE_MATCH", "NO_AIS_COVERAGE"])):
        flag = fixed_table(spark, ("sufficient",), [(enough,)])
        got = {r.detection_id: r.match_state for r in radar.match_states(det, pairs, flag).collect()}
        assert [got[k] for k in ("AMB-A", "AMB-B", "MATCHED", "POSSIBLE", "UNMATCHED")] == want


def test_single_bright_pixel_is_the_only_hit(spark):
    px = spark.range(101 * 101).select(F.lit(1).alias("scene_id"), F.floor(F.col("id") / 101).cast("int").alias("px_row"),
                                       (F.col("id") % 101).cast("int").alias("px_col"), F.lit(True).alias("valid"))
    px = px.withColumn("vv", F.when((F.col("px_row") == 50) & (F.col("px_col") == 50), 1.0).otherwise(0.01)).withColumn("vh", F.lit(0.01))
    hit = raster.cfar(px, P.CfarProfile("t", 10, 2, 1e-5), "vv", 101, 101).collect()
    assert [(r.px_row, r.px_col, r.excess_db > 0) for r in hit] == [(50, 50, True)]
    flat = px.withColumn("vh", F.col("vv")).withColumn("vv", F.lit(0.01))
    assert raster.union_seeds(raster.compare_profiles(flat, 101, 101)).count() == 0
    with pytest.raises(Exception, match="seed limit"):
        raster.guard_seeds(raster.compare_profiles(px, 101, 101), P.CfarParams(max_seeds=0)).count()


def test_components_link_after_dilation(spark):
    rng = random.Random(3)
    cells = {(rng.randrange(40), rng.randrange(40)) for _ in range(120)}
    seeds = fixed_table(spark, ("scene_id", "px_row", "px_col"), [(1, r, c) for r, c in cells])
    got = {(r.px_row, r.px_col): r.component for r in raster.label_components(seeds, 1).collect()}
    label, todo = {}, set(cells)
    while todo:
        group, queue = set(), [todo.pop()]
        while queue:
            a = queue.pop()
            group.add(a)
            near = {b for b in todo if max(abs(a[0] - b[0]), abs(a[1] - b[1])) <= 3}
            todo -= near
            queue.extend(near)
        for g in group:
            label[g] = min(group)
    pairs = [(a, b) for a in cells for b in cells if a < b]
    assert all((got[a] == got[b]) == (label[a] == label[b]) for a, b in pairs)


def test_newest_nonempty_takes_name_from_second_newest(spark):
    rows = spark.createDataFrame([(1, "273", "A", 1.0, "x"), (2, "273", "B", 2.0, "y"), (3, "273", "", 3.0, "x")],
                                 "seq int, mmsi string, name string, latitude double, src string")
    r = merge.newest_nonempty(rows, "mmsi", ("name", "latitude"), ("seq",), sources="src").first()
    assert (r.name, r.latitude, r.sources) == ("B", 3.0, ["x", "y"])


def test_port_match_deny_only_suppresses_alone(spark):
    ports = fixed_table(spark, ("unlocode", "port_name", "aliases"), [("RU LED", "St. Petersburg", "RULED;LED")])
    texts = fixed_table(spark, ("text",), [("PLGDN",), ("RU LED / PLGDN",), ("DEHAM",), ("to SANKT-PETERSBURG ST. PETERSBURG",)])
    got = {r.text: (r.matched, r.hits) for r in matching.port_hits(texts, matching.port_terms(ports)).collect()}
    assert got["PLGDN"] == (False, ["PLGDN"]) and got["RU LED / PLGDN"][0] and "DEHAM" not in got
    assert got["to SANKT-PETERSBURG ST. PETERSBURG"] == (True, ["STPETERSBURG"])


def test_port_match_on_long_texts_equals_substring_search(spark):
    rng = random.Random(5)
    words = ["USTLUGA", "KERCH", "AZOV", "TAMAN", "RUULU", "HAMBURG", "AZO", "LUGA", "GDANSK"]
    texts = [" ".join(rng.choice(words) for _ in range(400)) if i % 2 else "HAMBURG " * 300 for i in range(20)]
    terms = fixed_table(spark, ("term", "kind"), [("USTLUGA", "name"), ("KERCH", "name"), ("AZOV", "name"), ("RUULU", "code"), ("TAMAN", "name")])
    got = {r.text: set(r.hits) for r in matching.port_hits(fixed_table(spark, ("text",), [(x,) for x in texts]), terms).collect()}
    for x in texts:
        flat = x.replace(" ", "")
        want = {t for t in ("USTLUGA", "KERCH", "AZOV", "RUULU", "TAMAN", "GDANSK") if t in flat}
        assert got.get(x, set()) == want


def brute_runs(points, gap):
    entries, best, start, last, prev = 0, 0.0, None, None, False
    for t, near in points:
        entries += near and not prev
        prev = near
        if not near:
            start = last = None
            continue
        if last is not None and t - last > gap:
            start = t
        elif start is None:
            start = t
        last = t
        best = max(best, last - start)
    return entries, best


@pytest.mark.parametrize("chunk", [60, 7200, 10**9])
def test_runs_equal_sequential_rule_whatever_the_chunk(spark, chunk):
    rng = random.Random(chunk)
    rows, want = [], {}
    for k in range(6):
        t, pts = 0, []
        for _ in range(1 if k == 0 else 150):
            t += rng.choice([30, 60, 180, 181])
            pts.append((t, rng.random() < 0.6))
        want[k] = brute_runs(pts, 180)
        rows += [(k, i, ts("2024-01-01T00:00:00") + dt.timedelta(minutes=m)) for i, (m, near) in enumerate(pts) if near]
    df = spark.createDataFrame(rows, "k int, seq bigint, at timestamp")
    chunks = F.floor(F.unix_seconds("at") / chunk)
    got = {r.k: (r.entries, r.dwell_minutes) for r in keyed.near_runs(df, ["k"], chunks, "seq", "at", 180).collect()}
    assert got == {k: v for k, v in want.items() if v[0]}


def test_gap_of_exactly_the_limit_stays(spark):
    at = [0, 60, 120, 300, 481]
    df = spark.createDataFrame([(1, i, ts("2024-01-01T00:00:00") + dt.timedelta(minutes=m)) for i, m in enumerate(at)], "k int, seq bigint, at timestamp")
    r = keyed.near_runs(df, ["k"], F.lit(0), "seq", "at", 180).first()
    assert (r.entries, r.dwell_minutes) == (1, 300.0)


def test_chunked_helpers_equal_plain_windows(spark):
    rng = random.Random(1)
    data = [(rng.choice("aaab"), i, rng.randrange(1000), rng.choice([None, i])) for i in range(400)]
    df = spark.createDataFrame(data, "k string, id int, t int, v int")
    chunk = F.floor(F.col("t") / 50)
    ranked = {r.id: r.n for r in keyed.chunked_rank(df, ["k"], chunk, [F.col("t"), F.col("id")], "n").collect()}
    two = {r.id: r.n for r in keyed.chunked_sum(df, ["k"], chunk, [F.col("t"), F.col("id")], F.lit(1), "n",
                                                F.floor(F.col("_chunk") / 4)).collect()}
    around = {r.id: (r.b, r.a) for r in keyed.carry_around(df, ["k"], chunk, ["t", "id"], F.col("v"), "b", "a").collect()}
    by = defaultdict(list)
    for k, i, t, v in data:
        by[k].append((t, i, v))
    for rows in by.values():
        rows.sort(key=lambda x: x[:2])
        for n, (_t, i, _v) in enumerate(rows):
            assert ranked[i] == two[i] == n + 1
            before = [v for _, _, v in rows[:n + 1] if v is not None]
            after = [v for _, _, v in rows[n + 1:] if v is not None]
            assert around[i] == (before[-1] if before else None, after[0] if after else None)


def test_balanced_sample_equals_sequential_greedy(spark):
    rng = random.Random(9)
    rows = [(f"i{k}", f"{k}-{j}", ts("2024-01-01T00:00:00") + dt.timedelta(minutes=j * 7 + k), rng.randrange(40, 160), k == 2)
            for k in range(5) for j in range(rng.randrange(1, 30))]
    df = spark.createDataFrame(rows, "identity string, key string, at timestamp, size int, pri boolean")
    budget = 3000
    groups = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[2], r[1])):
        groups[r[0]].append(r)
    order = sorted(groups, key=lambda g: (not any(r[4] for r in groups[g]), -groups[g][-1][2].timestamp(), g))

    def mids(n):
        out, queue = [], [(1, n - 2)]
        while queue:
            lo, hi = queue.pop(0)
            if lo <= hi:
                m = (lo + hi) // 2
                out.append(m)
                queue += [(lo, m - 1), (m + 1, hi)]
        return out

    turns = {g: [len(groups[g]) - 1, 0, *mids(len(groups[g]))] for g in order}
    taken, used = set(), 0
    for i in range(max(map(len, turns.values()))):
        for g in order:
            if i < len(turns[g]):
                r = groups[g][turns[g][i]]
                if r[1] not in taken and used + r[3] <= budget:
                    taken.add(r[1])
                    used += r[3]
    got = {r.key for r in history.balanced_sample(df, "identity", "at", "key", "pri", F.col("size"), budget).where("sampled").collect()}
    assert got == taken and len(got) < len(rows)


def test_parts_never_exceed_the_limit_and_compaction_is_idempotent(spark):
    rng = random.Random(2)
    rows = [(f"k{i % 90}", i, ts("2024-01-20T00:00:00") + dt.timedelta(minutes=11 * i), rng.randrange(50, 300)) for i in range(200)]
    df = spark.createDataFrame(rows, "key string, seq int, at timestamp, size int")
    as_of = F.lit("2024-01-31").cast("timestamp")
    once = history.compact(df, "key", "at", "seq", as_of)
    assert once.count() == 90 == history.compact(once, "key", "at", "seq", as_of).count()
    parts = history.assign_parts(once, "at", "key", F.col("size"), 700)
    sizes = parts.groupBy("date_utc", "part").agg(F.sum("line_bytes").alias("b")).collect()
    assert len(sizes) > 1 and max(r.b for r in sizes) <= 700
    assert history.disjoint_violations(parts, "key").count() == 0


def test_far_feature_never_changes_events(spark):
    pts = [(f"v{k}", i, ts("2024-01-01T00:00:00") + dt.timedelta(minutes=20 * i), 55.0 + 0.001 * (i % 3), 12.0 + 0.002 * k, 1.0, True)
           for k in range(3) for i in range(12)]
    track = spark.createDataFrame(pts, "mmsi string, id int, at timestamp, latitude double, longitude double, sog double, timestamp_valid boolean")
    near = fixed_table(spark, ("feature_id", "infrastructure_type", "a_lon", "a_lat", "b_lon", "b_lat"), [("n", "pipeline", 11.9, 55.0, 12.1, 55.0)])
    far = near.unionByName(fixed_table(spark, near.columns, [("f", "pipeline", 20.0, 60.0, 21.0, 61.0)]))
    run = lambda s: sorted(map(str, proximity.proximity_events(track, s, "mmsi", "at", "id").select(
        "mmsi", "feature_id", "level", "entries", "dwell_minutes").collect()))
    assert run(near) == run(far) and len(run(near)) == 3


def test_distance_inside_a_polygon_is_to_its_ring(spark):
    ring = spark.createDataFrame([("p", '{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,2],[0,0]]]}')], "feature_id string, geometry string")
    pts = fixed_table(spark, ("id", "feature_id", "longitude", "latitude"), [(1, "p", 1.0, 1.0)])
    d = sp.feature_distance(pts, sp.geometry_segments(ring), ["id"]).first().distance_nm
    assert d == pytest.approx(60.0, rel=0.01)
    assert sp.inside_polygon(pts.drop("feature_id"), sp.geometry_segments(ring), ["id"], 0.5).count() == 1


def test_grid_join_equals_brute_force(spark):
    rng = random.Random(4)
    pts = [(i, rng.uniform(8, 9), rng.uniform(54, 55)) for i in range(150)]
    segs = [(f"s{i}", rng.uniform(8, 9), rng.uniform(54, 55), rng.uniform(8, 9), rng.uniform(54, 55)) for i in range(25)]
    p = fixed_table(spark, ("id", "longitude", "latitude"), pts)
    s = fixed_table(spark, ("feature_id", "a_lon", "a_lat", "b_lon", "b_lat"), segs)
    got = {(r.id, r.feature_id) for r in sp.near_pairs(p, s, 2.0, 0.05, ["id"], []).collect()}
    every = p.withColumn("feature_id", F.explode(F.array(*[F.lit(x[0]) for x in segs])))
    want = {(r.id, r.feature_id) for r in sp.feature_distance(every, s, ["id"]).where("distance_nm <= 2.0").collect()}
    assert got == want and want


def test_review_objects_keep_every_detection_once(spark):
    rows = [(1, "A", True), (1, "B", False), (2, "C", True), (3, "D", True)]
    members = spark.createDataFrame(rows, "object_id int, detection_id string, is_representative boolean")
    objects = members.groupBy("object_id").agg(F.collect_list("detection_id").alias("detection_ids"))
    assert review.preserved_once(members, objects).count() == 0
    assert review.preserved_once(members, objects.where("object_id <> 2")).count() == 1


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("u"), F.lpad((F.col("id") + 1).cast("string"), 4, "0").alias("v"))
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    assert {r.component for r in graph.connected_components(nodes, edges).collect()} == {"0000"}


def test_route_state_ladder():
    day = 86400 * 1_000_000
    state = (False, None, 0, 0, 0)
    state, flags = step(state, 1, "RU LED", True, False)
    assert flags[0] and flags[3]
    state, flags = step(state, day, None, False, False)
    assert flags[0] and not flags[1] and not any(flags[3:])
    state, flags = step(state, 2 * day, "DEHAM", False, False)
    assert not flags[0] and flags[1] and flags[4]
    state, flags = step(state, 13 * day, None, False, False)
    assert flags == (False, False, False, False, False, False)


def test_track_lines_hold_every_vertex(spark):
    start = dt.datetime(2026, 1, 1)
    rows = [(m, start + dt.timedelta(minutes=i // 2), 50.0 + i % 7, float(i)) for m, n in ((1, 1), (2, 2), (3, 1000), (4, 1999), (5, 2500)) for i in range(n)]
    df = spark.createDataFrame(rows, "mmsi int, at timestamp, latitude double, longitude double")
    points = history.track_points(df, "mmsi", "at", F.lit(start))
    got = defaultdict(dict)
    for r in history.track_lines(points, "mmsi", "at").collect():
        got[r.mmsi][r.piece] = [tuple(v) for v in r.path]
    assert {m: sorted(map(len, p.values())) for m, p in got.items()} == {2: [2], 3: [1000], 4: [1000, 1000], 5: [502, 1000, 1000]}
    for m, pieces in got.items():
        track = pieces[len(pieces) - 1]
        for k in range(len(pieces) - 2, -1, -1):
            assert pieces[k][0] == track[-1]
            track = track + pieces[k][1:]
        assert track == [(at, lon, lat) for _, at, lat, lon in sorted(r for r in rows if r[0] == m)]


def test_ships_of_one_name_stay_apart(spark):
    rows = [("2024-01-02", "9000001", "219000001", "OXA1", "Atlas"), ("2024-01-02", "9000002", "219000002", None, "ATLAS"),  # two ships
            ("2024-01-03", None, None, None, "atlas"), ("2024-01-03", None, "219000001", None, None), ("2024-01-03", None, None, "OXA1", "Solo"),
            ("2024-03-05", "9000002", "219000002", None, "Atlas"), ("2024-03-06", None, None, None, "Atlas"),  # later one alone
            ("2024-03-05", "9000003", "219000009", "OX", None), ("2024-03-05", "9000004", "219000009", "OX", None),  # a shared MMSI
            ("2024-03-05", None, "219000009", None, "Twin"), (None, "9000005", None, None, "Timeless")]
    df = spark.createDataFrame(rows, "day string, imo string, mmsi string, callsign string, name string").withColumn("observed_at", F.to_timestamp("day"))
    out = matching.alias_owners(df.unionByName(df)).collect()
    owner = {(row.period, row.alias): (row.canonical, row.ambiguous) for row in out}
    assert len(owner) == len(out)
    first, later = 19724 // 30, 19787 // 30
    assert owner[first, "name:ATLAS"] == ("name:ATLAS", True) and owner[later, "name:ATLAS"] == ("imo:9000002", False)
    assert owner[first, "mmsi:219000001"] == ("imo:9000001", False) and owner[first, "name:SOLO"] == ("imo:9000001", False)
    assert owner[later, "mmsi:219000009"] == ("mmsi:219000009", True) and owner[later, "callsign:OX"] == ("callsign:OX", True)
    assert owner[later, "name:TWIN"] == ("mmsi:219000009", False) and owner[None, "name:TIMELESS"] == ("imo:9000005", False)
    assert all(alias == canonical for (_, alias), (canonical, _) in owner.items() if alias.startswith("imo:"))
    assert matching.alias_owners(df.limit(0)).collect() == []


def test_rows_of_one_moment_are_spread_over_ranges_and_summed_in_order(spark):
    df = spark.range(5_000).selectExpr("id", "timestamp'2024-01-01 00:00:00' AS t", "CAST(id % 7 + 1 AS BIGINT) AS size", "IF(id % 50 = 0, NULL, 'k') AS k")
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")  # else so few rows are one range
    try:
        ranges = [r["count"] for r in keyed.in_ranges(df, [], [F.col("t"), F.col("id")]).groupBy(keyed.CHUNK).count().collect()]
        assert len(ranges) > 4 and max(ranges) < 1_500
        got = {r.id: (r.run, r.n) for r in keyed.ranged_sums(df, ["k"], [F.col("t"), F.col("id").desc()], {"run": F.col("size"), "n": F.lit(1)}).collect()}
    finally:
        spark.conf.set(name, before)
    run, n = {True: 0, False: 0}, {True: 0, False: 0}
    for i in reversed(range(5_000)):
        null = i % 50 == 0
        run[null] += i % 7 + 1
        n[null] += 1
        assert got[i] == (run[null], n[null])
    assert keyed.ranged_sums(df.limit(0), [], [F.col("t"), F.col("id")], {"run": F.col("size")}).collect() == []


def test_a_product_is_replaced_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "product")
    df = spark.range(20).selectExpr("id", "IF(id = 3, NULL, 'é') AS name")
    size = sinks.write_if_small(df, path, 10_000)
    assert size == sinks.product_bytes(df).first()["bytes"] and sinks.write_if_small(df.limit(5), path) < size
    with pytest.raises(ValueError, match="previous product kept"):
        sinks.write_if_small(df, path, 10)
    assert spark.read.json(path).count() == 5 and sorted(p.name for p in tmp_path.iterdir()) == ["product"]
    assert sinks.write_if_small(df.limit(0), path) == 0
