"""Per-key ranking, running sums and carries that stay spread out when one key is huge.

A window over a single busy key would run in one task. These helpers split every key into
ordered chunks (usually time chunks), work inside the chunks, and stitch the chunks together
over one small summary row per chunk. ``chunk`` must be monotone in ``order``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.functions.records import scaled_round
from wakeline.session import cut_lineage, stored

CHUNK = "_chunk"


def top_k(df: DataFrame, keys: Sequence, order: Sequence[Column], k: int | None = 1, rank: str | None = None) -> DataFrame:
    """First ``k`` rows per key. Catalyst limits each group before the shuffle, so a hot key ships k rows per task.

    With ``k`` None every row is ranked and kept; use ``chunked_rank`` where a key may be hot.
    """
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    out = out if k is None else out.where(F.col(name) <= k)
    return out if rank else out.drop(name)


def within(rank: str, limit: int | None) -> Column:
    """Whether a rank is inside an optional limit; without one every row is."""
    return F.lit(True) if limit is None else F.col(rank) <= limit


def _summary_window(keys: Sequence[str]):
    return Window.partitionBy(*[F.col(k) for k in keys]).orderBy(CHUNK)


def _join_back(df: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    on = F.lit(True)
    for name in [*keys, CHUNK]:
        on = on & df[name].eqNullSafe(summary["_s_" + name])
    joined = df.join(summary, on, "left")
    return joined.drop(*["_s_" + name for name in [*keys, CHUNK]])


def _as_summary(df: DataFrame, keys: Sequence[str], *values: str) -> DataFrame:
    return df.select(*[F.col(k).alias("_s_" + k) for k in [*keys, CHUNK]], *values)


def chunked_rank(df: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[Column], out: str) -> DataFrame:
    """``row_number`` per key, computed chunk by chunk."""
    return chunked_sum(df, keys, chunk, order, F.lit(1).cast("bigint"), out)


def chunked_sum(df: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[Column], value: Column,
                out: str, coarse: Column | None = None) -> DataFrame:
    """Running sum of ``value`` per key up to and including the row.

    ``coarse`` (an expression over the chunk column) adds a second level where the chunks
    themselves are too many for one task.
    """
    rows = df.withColumn(CHUNK, chunk).withColumn("_v", value)
    totals = rows.groupBy(*keys, CHUNK).agg(F.sum("_v").alias("_t"))
    if coarse is None:
        before = _summary_window(keys).rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.withColumn("_o", F.coalesce(F.sum("_t").over(before), F.lit(0)))
    else:
        fine = totals.withColumn("_big", coarse).withColumnRenamed(CHUNK, "_fine")
        totals = (chunked_sum(fine, keys, F.col("_big"), [F.col("_fine")], F.col("_t"), "_upto")
                  .withColumn(CHUNK, F.col("_fine")).withColumn("_o", F.col("_upto") - F.col("_t")))
    offsets = _as_summary(totals, keys, "_o")
    inner = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_r", F.sum("_v").over(inner))
    return (_join_back(local, offsets, keys)
            .withColumn(out, F.col("_r") + F.col("_o")).drop(CHUNK, "_v", "_r", "_o"))


def in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows with the number of their range of (keys, order), as a chunk that is monotone in that order.

    Bounds are sampled from the rows themselves, so ranges follow the data: rows that share a key and a time are
    still spread by the rest of the order. Rows equal in all of it stay together. Checkpointed, so numbers hold.
    """
    return cut_lineage(df.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn(CHUNK, F.spark_partition_id()))


def ranged_sums(df: DataFrame, keys: Sequence[str], order: Sequence[Column], values: dict[str, Column]) -> DataFrame:
    """Running sums per key up to and including the row, as a prefix scan over ranges of rows.

    Each range is summed by itself, and the ranges before it are added from one small row per key and range; their
    number is that of the shuffle partitions plus the keys. ``order`` must tell the rows of a key apart.
    """
    rows = in_ranges(df.withColumns({"_v_" + n: v for n, v in values.items()}), keys, order)
    totals = rows.groupBy(*keys, CHUNK).agg(*[F.sum("_v_" + n).alias("_t_" + n) for n in values])
    before = _summary_window(keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumns({"_o_" + n: F.coalesce(F.sum("_t_" + n).over(before), F.lit(0)) for n in values})
    inner = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({"_r_" + n: F.sum("_v_" + n).over(inner) for n in values})
    joined = _join_back(local, _as_summary(offsets, keys, *["_o_" + n for n in values]), keys)
    return joined.withColumns({n: F.col("_r_" + n) + F.col("_o_" + n) for n in values}).drop(
        CHUNK, *[p + n for n in values for p in ("_v_", "_r_", "_o_")])


def carry_last(df: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[str], values: dict[str, Column],
               inclusive: bool = True) -> DataFrame:
    """Last non-null of each value among a key's earlier rows (the row itself too if ``inclusive``)."""
    rows = df.withColumn(CHUNK, chunk)
    for name, value in values.items():
        rows = rows.withColumn("_v_" + name, value)
    position = F.struct(*order)
    lasts = rows.groupBy(*keys, CHUNK).agg(*[
        F.max_by("_v_" + n, F.when(F.col("_v_" + n).isNotNull(), position)).alias("_l_" + n) for n in values])
    before = _summary_window(keys).rowsBetween(Window.unboundedPreceding, -1)
    for name in values:
        lasts = lasts.withColumn("_c_" + name, F.last("_l_" + name, ignorenulls=True).over(before))
    carried = _as_summary(lasts, keys, *["_c_" + n for n in values])
    inner = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    local = rows
    for name in values:
        local = local.withColumn("_i_" + name, F.last("_v_" + name, ignorenulls=True).over(inner))
    joined = _join_back(local, carried, keys)
    for name in values:
        joined = joined.withColumn(name, F.coalesce("_i_" + name, "_c_" + name))
    helpers = [p + n for n in values for p in ("_v_", "_i_", "_c_")]
    return joined.drop(CHUNK, *helpers)


def carry_around(df: DataFrame, keys: Sequence[str], chunk: Column | None, order: Sequence[str], value: Column,
                 before: str, after: str, place: Sequence[str] = ()) -> DataFrame:
    """Last non-null value up to the row and first non-null value after it, in one ordered pass.

    Rows whose chunk is NULL, all rows without one, are a single chunk of their key and need no summary. ``place``:
    columns the rows of a chunk share and are dealt by already.
    """
    rows = df.withColumn("_v", value) if chunk is None else df.withColumns({CHUNK: chunk, "_v": value})
    group = [*place, *keys, *([] if chunk is None else [CHUNK])]
    inner = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    names = lambda columns: ", ".join(f"`{c}`" for c in columns)
    # As lead, since a frame that is open at its end is read again for each row.
    following = F.expr(f"lead(_v) IGNORE NULLS OVER (PARTITION BY {names(group)} ORDER BY {names(order)})")
    local = rows.withColumns({"_ib": F.last("_v", ignorenulls=True).over(inner), "_ia": following})
    if chunk is None:
        return local.withColumnsRenamed({"_ib": before, "_ia": after}).drop("_v")
    position = F.when(F.col("_v").isNotNull(), F.struct(*order))
    ends = rows.where(F.col(CHUNK).isNotNull()).groupBy(*keys, CHUNK).agg(
        F.max_by("_v", position).alias("_hi"), F.min_by("_v", position).alias("_lo"))
    w = _summary_window(keys)
    ends = ends.withColumns({
        "_b": F.last("_hi", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        "_a": F.first("_lo", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))})
    # Stored, so that Spark sees how small it is and leaves the rows where they are.
    joined = _join_back(local, stored(_as_summary(ends, keys, "_b", "_a")), keys)
    return joined.withColumns({before: F.coalesce("_ib", "_b"), after: F.coalesce("_ia", "_a")}).drop(
        CHUNK, "_v", "_ib", "_ia", "_b", "_a")


def near_runs(near: DataFrame, keys: Sequence[str], chunk: Column, seq: str, at: str, max_gap_minutes: float
              ) -> DataFrame:
    """Entries and longest dwell per key from numbered near rows.

    ``seq`` numbers all rows of the track, so a step other than 1 means a far row lies between.
    An entry is a near row whose predecessor is not near. A stay ends on a far row or on a gap
    above ``max_gap_minutes`` (a gap of exactly that length stays in one stay).
    """
    gap_us = int(max_gap_minutes * 60_000_000)
    rows = near.withColumn(CHUNK, chunk).withColumn("_t", F.unix_micros(at))
    w = Window.partitionBy(*keys, CHUNK).orderBy(seq)
    rows = (rows.withColumn("_ps", F.lag(seq).over(w)).withColumn("_pt", F.lag("_t").over(w))
            .withColumn("_edge", F.col("_ps").isNotNull() & (F.col(seq) != F.col("_ps") + 1))
            .withColumn("_break", F.col("_ps").isNull() | F.col("_edge") | (F.col("_t") - F.col("_pt") > gap_us))
            .withColumn("_stay", F.sum(F.col("_break").cast("int")).over(
                w.rowsBetween(Window.unboundedPreceding, 0))))
    stays = rows.groupBy(*keys, CHUNK, "_stay").agg(
        F.min(seq).alias("_s0"), F.max(seq).alias("_s1"), F.min("_t").alias("_t0"), F.max("_t").alias("_t1"),
        F.sum(F.col("_edge").cast("bigint")).alias("_e"))
    # Only a chunk's first and last stay can continue in a neighbour chunk; the rest is settled here.
    ends = F.struct("_s0", "_s1", "_t0", "_t1")
    per_chunk = stays.groupBy(*keys, CHUNK).agg(
        F.min(ends).alias("_first"), F.max(ends).alias("_last"),
        F.max(F.col("_t1") - F.col("_t0")).alias("_inner"), F.sum("_e").alias("_edges"))
    bounds = per_chunk.select(
        *keys, CHUNK, "_inner", "_edges",
        F.posexplode(F.array_distinct(F.array("_first", "_last"))).alias("_pos", "_stay"))
    bw = Window.partitionBy(*keys).orderBy(CHUNK, "_pos")
    prev = F.lag("_stay").over(bw)
    bounds = (bounds
              .withColumn("_joined", F.coalesce((F.col("_stay._s0") == prev["_s1"] + 1)
                                                & (F.col("_stay._t0") - prev["_t1"] <= gap_us), F.lit(False)))
              .withColumn("_head_edge", F.when(F.col("_pos") == 0, F.coalesce(
                  F.col("_stay._s0") != prev["_s1"] + 1, F.lit(True)).cast("bigint")).otherwise(F.lit(0)))
              .withColumn("_island", F.sum((~F.col("_joined")).cast("int")).over(
                  bw.rowsBetween(Window.unboundedPreceding, 0))))
    islands = bounds.groupBy(*keys, "_island").agg(
        (F.max("_stay._t1") - F.min("_stay._t0")).alias("_span"), F.max("_inner").alias("_inner"),
        F.sum(F.when(F.col("_pos") == 0, F.col("_edges")).otherwise(F.lit(0))).alias("_edges"),
        F.sum("_head_edge").alias("_heads"))
    return islands.groupBy(*keys).agg(
        (F.sum("_edges") + F.sum("_heads")).alias("entries"),
        (F.greatest(F.max("_span"), F.max("_inner")) / 60e6).alias("dwell_minutes"))


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float],
                      bucket: Column, places: int = 6) -> DataFrame:
    """Exact interpolated percentiles per key without holding a key's values in one task.

    Values are counted per (key, bucket), the buckets holding the wanted ranks are found on the
    small count table, and only those buckets are ranked. ``bucket`` must be monotone in ``value``.
    """
    counted = df.withColumn(CHUNK, bucket).groupBy(*keys, CHUNK, value).agg(F.count("*").alias("_n"))
    totals = counted.groupBy(*keys, CHUNK).agg(F.sum("_n").alias("_n"))
    full = Window.partitionBy(*keys)
    w = full.orderBy(CHUNK)
    totals = (totals.withColumn("_end", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("_all", F.sum("_n").over(full)).withColumn("_start", F.col("_end") - F.col("_n")))
    wanted = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("p")) for p in probabilities]))
    ranks = (totals.select(*keys, CHUNK, "_start", "_end", "_all", wanted.alias("_w"))
             .withColumn("_h", F.col("_w.p") * (F.col("_all") - 1))
             .withColumn("_lo", F.floor("_h")).withColumn("_hi", F.ceil("_h"))
             .where(((F.col("_lo") >= F.col("_start")) & (F.col("_lo") < F.col("_end")))
                    | ((F.col("_hi") >= F.col("_start")) & (F.col("_hi") < F.col("_end")))))
    inner = Window.partitionBy(*keys, CHUNK).orderBy(value)
    placed = counted.withColumn("_c1", F.sum("_n").over(inner.rowsBetween(Window.unboundedPreceding, 0)))
    hits = placed.withColumnRenamed("_n", "_vn").join(ranks, [*keys, CHUNK])
    first, last = F.col("_start") + F.col("_c1") - F.col("_vn"), F.col("_start") + F.col("_c1")
    at = lambda rank: F.max(F.when((F.col(rank) >= first) & (F.col(rank) < last), F.col(value)))
    picked = hits.groupBy(*keys, F.col("_w.p").alias("p"), "_h", "_lo").agg(at("_lo").alias("_a"), at("_hi").alias("_b"))
    part = F.col("_h") - F.col("_lo")
    return picked.select(*keys, "p", scaled_round(F.col("_a") * (1.0 - part) + F.col("_b") * part, places).alias("value"))
