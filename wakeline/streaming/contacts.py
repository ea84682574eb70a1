"""Live contacts, idempotent events and history upkeep with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wakeline import params as P
from wakeline.operators.filters import retention_reject
from wakeline.operators.history import compact
from wakeline.operators.merge import filled
from wakeline.session import cut_lineage


def latest_contacts_into(path: str, key: str, fields: Sequence[str], order: Sequence[str], at: str | None = None,
                         as_of: Column | None = None, days: int = 120) -> Callable[[DataFrame, int], None]:
    """Batch function that merges rows into a table of the last non-empty values per identity.

    The table holds one row per key: each field with the position it came from. A batch is reduced
    first, then merged with the version before it, and written as a version of its own, so a replayed
    batch gives the same version. With ``at`` and ``as_of``, keys not seen for ``days`` leave the table,
    so it is bounded by the vessels of that time.
    """
    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        here = F.struct(*order)
        rows = batch.where(F.col(key).isNotNull()).select(
            key, F.lit(1).cast("bigint").alias("merged_rows"), (F.col(at) if at else F.lit(None).cast("timestamp")).alias("last_at"),
            *[c for f in fields for c in (F.col(f), F.when(filled(batch, f), here).alias("_at_" + f))])
        old = _stored(spark, path)
        if old is not None:
            version = old.where(F.col("version") < number).agg(F.max("version")).first()[0]
            if version is not None:
                rows = old.where(F.col("version") == version).select(*rows.columns).unionByName(rows)
        merged = rows.groupBy(key).agg(
            F.sum("merged_rows").alias("merged_rows"), F.max("last_at").alias("last_at"),
            *[c for f in fields for c in (F.max_by(f, "_at_" + f).alias(f), F.max("_at_" + f).alias("_at_" + f))])
        if at and as_of is not None:
            merged = merged.where(F.col("last_at") >= as_of - F.make_dt_interval(F.lit(days)))
        merged.write.mode("overwrite").parquet(f"{path}/version={number}")

    return merge


def read_contacts(spark: SparkSession, path: str, key: str, fields: Sequence[str]) -> DataFrame:
    """The newest version of the table."""
    rows = spark.read.parquet(path)
    return rows.join(rows.agg(F.max("version").alias("version")), "version").select(key, *fields, "merged_rows")


def unique_events(stream: DataFrame, at: str, event_id: str = "event_id", delay: str = "10 days") -> DataFrame:
    """Each event id once within the watermark delay."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([event_id])


def timely(stream: DataFrame, at: str, as_of: Column, policy: P.HistoryPolicy = P.HistoryPolicy()) -> DataFrame:
    """Rows inside the retention window; ``reject_counter`` counts the late, future and undated ones left out."""
    reason = retention_reject(F.col(at), as_of, policy.retention_days, policy.future_tolerance_hours)
    return stream.where(reason.isNull())


def reject_counter(at: str, as_of: Column, path: str, policy: P.HistoryPolicy = P.HistoryPolicy()
                   ) -> Callable[[DataFrame, int], None]:
    """Batch function that writes per-batch reject counts."""
    def count(batch: DataFrame, number: int) -> None:
        reason = F.coalesce(retention_reject(F.col(at), as_of, policy.retention_days, policy.future_tolerance_hours),
                            F.lit("kept"))
        batch.groupBy(reason.alias("reason")).agg(F.count("*").alias("n")).withColumn("batch", F.lit(number)).write.mode(
            "overwrite").parquet(f"{path}/batch={number}")

    return count


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise  # a history that cannot be read is no empty history


def _drop_days(spark: SparkSession, path: str, days: list) -> None:
    """Removes whole day partitions of the history."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for day in days:
        store.delete(jvm.org.apache.hadoop.fs.Path(root, f"date_utc={day}"), True)


def compact_into(path: str, key: str, at: str, seq: str, as_of: Column, policy: P.HistoryPolicy = P.HistoryPolicy()
                 ) -> Callable[[DataFrame, int], None]:
    """Batch function that merges rows into a day-partitioned history.

    Only the days the batch touches, and the days that hold an older copy of its keys, are read
    and rewritten. The merged rows are checkpointed first, so the rewrite never reads what it
    replaces. Days that ended before the retention window leave the store with every merge. Replaying a
    batch gives the same files.
    """
    def merge(batch: DataFrame, _number: int) -> None:
        spark = batch.sparkSession
        fresh = cut_lineage(compact(batch, key, at, seq, as_of, policy).withColumn("date_utc", F.to_date(at)))
        old = _stored(spark, path)
        merged = fresh
        if old is not None:
            keys = fresh.select(key)
            touched = fresh.select("date_utc").unionByName(old.join(keys, key, "left_semi").select("date_utc")).distinct()
            # At most one entry per retained day.
            days = [r.date_utc for r in touched.collect()]
            kept = old.where(F.col("date_utc").isin(days)).select(*fresh.columns)
            merged = cut_lineage(compact(kept.unionByName(fresh), key, at, seq, as_of, policy))
        (merged.write.partitionBy("date_utc").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))
        if old is not None:
            # Partition values only, and no more than a few days past the window: every merge removes them.
            last = F.to_date(as_of - F.make_dt_interval(F.lit(policy.retention_days)))
            _drop_days(spark, path, [r.date_utc for r in old.select("date_utc").distinct().where(F.col("date_utc") < last).collect()])

    return merge


def read_compacted(spark: SparkSession, path: str, key: str, at: str, seq: str, as_of: Column,
                   policy: P.HistoryPolicy = P.HistoryPolicy()) -> DataFrame:
    """Newest row per key inside the retention window; a day whose last rows all moved elsewhere is settled here."""
    return compact(spark.read.parquet(path), key, at, seq, as_of, policy)


def run_once(stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Processes everything available and stops."""
    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(batch).start())
    query.awaitTermination()


#: The state store that timers and growing state need; the default one holds all state on the heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def run_to_files(stream: DataFrame, checkpoint: str, path: str) -> StreamingQuery:
    """Processes everything available into Parquet files and stops."""
    query = (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
             .option("path", path).trigger(availableNow=True).start())
    query.awaitTermination()
    return query
