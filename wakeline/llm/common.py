"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.session import checkpoint_dir

#: Rows of one Arrow batch: long texts must not add up to more than a worker can hold.
BATCH_ROWS = 500


def settle(spark: SparkSession) -> SparkSession:
    """Session settings the operators count on: small Arrow batches and a reliable checkpoint folder."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    checkpoint_dir(spark)
    return spark


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """One of the given tables, only the columns asked for."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


#: Numbers an id is hashed to for a first test; at most so many are broadcast, whatever the data.
ID_BUCKETS = 1 << 20


def split_by_ids(df: DataFrame, id_col: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose id may be in ``ids``, rows whose id is not), without a shuffle of ``df``.

    The ids are hashed to ID_BUCKETS numbers and those in use are broadcast. A join on the id itself has to
    follow for the first part; with many ids that part is nearly all of ``df``.
    """
    name = free_name(df, "id_bucket")
    bucket = F.pmod(F.xxhash64(F.col(id_col), F.lit(17)), F.lit(ID_BUCKETS)).alias(name)
    used = F.broadcast(ids.select(bucket).distinct())
    marked = df.select("*", bucket)
    return marked.join(used, name, "left_semi").drop(name), marked.join(used, name, "left_anti").drop(name)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name no column of ``df`` has (names are compared without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


class Memo(dict):
    """``memo[key]`` computes a missing value once. Holds at most ``most`` keys: when half are new, those that were
    not asked for since the last time go, so memory is bounded and common keys stay.

    ``many`` computes the values of a list of keys at once.
    """

    def __init__(self, compute: Callable, most: int = 1 << 17, many: Callable[[list], Iterable] | None = None):
        super().__init__()
        self.compute, self.half, self.older = compute, most // 2, {}
        self.many = many or (lambda keys: map(compute, keys))

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self.take({key: value})
        return value

    def take(self, found: dict) -> None:
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self.update(found)

    def fetch(self, keys: set) -> dict:
        """Values of keys that are not held."""
        older = self.older
        found = {k: older[k] for k in keys if k in older}
        new = list(keys.difference(found))
        if new:
            found.update(zip(new, self.many(new)))
        self.take(found)
        return found


#: Chunks longer than this are encoded without being remembered.
MEMO_CHARS = 64

#: A space before a character other than white space; a space before white space or the end.
_CUT, _GLUE = re.compile(r" (?=\S)"), re.compile(r" (?:\s|$)")


def by_chunks(text: str, memo: Memo, encode: Callable[[str], bytes]) -> bytes:
    """``encode(text)`` put together from chunks, those up to MEMO_CHARS remembered in ``memo`` (which adds the space).

    The text is cut before every space that is followed by a character other than white space. No match of
    the byte-level pattern reaches across such a place, so the chunks can be encoded on their own.
    """
    first, *rest = _CUT.split(text) if _GLUE.search(text) else text.split(" ")
    parts = list(map(memo.get, rest))
    if None in parts:
        at = [i for i, part in enumerate(parts) if part is None]
        found = memo.fetch({rest[i] for i in at if len(rest[i]) <= MEMO_CHARS})
        for i in at:
            parts[i] = found[rest[i]] if len(rest[i]) <= MEMO_CHARS else encode(" " + rest[i])
    return encode(first) + b"".join(parts)


def list_array(parts: Iterable[bytes], kind: pa.DataType, width: int) -> pa.Array:
    """Arrow lists of fixed-width little-endian numbers, one list for each byte string."""
    parts = list(parts)
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) // width for p in parts], out=offsets[1:])
    values = pa.Array.from_buffers(kind, int(offsets[-1]), [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
