"""Exact top-k by integer inner product, with a pivot table that rules candidates out.

An inner product is turned into a distance by one more component: every vector gets sqrt(M - |x|^2), where M is
the largest squared length of all, and a query gets 0, so that the nearest vectors have the highest products.
Every block of candidates has pivots of its own; for a query, the largest difference of its own and a
candidate's distance to a pivot is a lower bound of theirs. Queries near the same pivot are searched together:
candidates are evaluated in the order of their least bound, in steps, until the bounds pass the k-th best of
every query. Queries and candidates meet as blocks of rows; every block pair gives its k best, and the best
of those are the answer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import settle
from wakeline.session import cut_lineage

#: Vectors of a block, queries that are searched together, and pivots of a block.
BLOCK, QUERY_BLOCK, GROUP, PIVOTS = 8192, 512, 64, 24
#: Candidates evaluated at a time, and how much a float distance may be off (of the largest).
STEP, SLACK = 1024, 1e-5
#: Beyond this, floats do not hold products exactly and whole numbers are used.
EXACT = 2 ** 53


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): every component as floor(scale * x). Vectors that are NULL, empty, or hold a NULL or non-finite
    component are left out, and so are rows without an id."""
    x = F.col(vector_col).cast("array<double>")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(x) > 0) & sound)
            .select(F.col(id_col).cast("bigint").alias("id"), F.transform(x, lambda c: F.floor(c * scale)).alias("v")))


def _blocks(vectors: DataFrame, rows: int, name: str, pivots: int = 0) -> DataFrame:
    """Vectors packed as (dim, name, ids, data, pivots): blocks of about ``rows`` rows of one length, dealt by hash.

    pivots: rows of the block, each far from those before, so that they see the others from all sides.
    """
    sizes = vectors.groupBy(F.size("v").alias("dim")).agg(F.ceil(F.count("*") / rows).alias("blocks"))
    dealt = (vectors.withColumn("dim", F.size("v")).join(sizes, "dim")
             .withColumn(name, F.pmod(F.xxhash64("id", F.lit(5)), F.col("blocks"))))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids = table.column("id").to_numpy().astype("<i8")
        flat = table.column("v").combine_chunks().flatten().to_numpy().astype("<i8")
        x = flat.reshape(len(ids), -1).astype(float)
        chosen = [0] if pivots else []
        nearest = np.full(len(x), np.inf)
        while chosen and len(chosen) < min(pivots, len(x)):
            away = x - x[chosen[-1]]
            nearest = np.minimum(nearest, (away * away).sum(1))
            chosen.append(int(nearest.argmax()))
        return pa.table({"dim": table.column("dim")[:1], name: table.column(name)[:1], "ids": pa.array([ids.tobytes()], pa.binary()),
                         "data": pa.array([flat.tobytes()], pa.binary()), "pivots": pa.array([chosen], pa.list_(pa.int32()))})

    return dealt.select("dim", name, "id", "v").groupBy("dim", name).applyInArrow(
        pack, f"dim int, {name} bigint, ids binary, data binary, pivots array<int>")


def _distances(a: np.ndarray, lift_a: np.ndarray, b: np.ndarray, lift_b: np.ndarray) -> np.ndarray:
    """Euclidean distances of lifted vectors, all of a against all of b."""
    squared = (a * a).sum(1)[:, None] + (lift_a ** 2)[:, None] + (b * b).sum(1) + lift_b ** 2 - 2 * (a @ b.T + np.outer(lift_a, lift_b))
    return np.sqrt(np.maximum(squared, 0))


def _best(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(batches):
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(7)]):
                out = one_pair(*row)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], schema=schema)

    def one_pair(dim, top, q_ids, q_data, ids, data, pivots):
        q_ids, ids = np.frombuffer(q_ids, "<i8"), np.frombuffer(ids, "<i8")
        qi, xi = np.frombuffer(q_data, "<i8").reshape(-1, dim), np.frombuffer(data, "<i8").reshape(-1, dim)
        q, x = qi.astype(float), xi.astype(float)
        exact = float(np.abs(q).max()) * float(np.abs(x).max()) * dim < EXACT
        lift = np.sqrt(np.maximum(top - (x * x).sum(1), 0))
        to_pivot = _distances(x[pivots], lift[pivots], x, lift)  # by pivot, then candidate
        q_to_pivot = _distances(q, np.zeros(len(q)), x[pivots], lift[pivots])
        slack = SLACK * (np.sqrt(top) + np.sqrt((q * q).sum(1).max()) + 1)
        near = np.argsort(q_to_pivot.argmin(1), kind="stable")
        out = []
        for a in range(0, len(q), GROUP):
            out += one_group(near[a:a + GROUP], qi, xi, q, x, exact, top, q_ids, ids, to_pivot, q_to_pivot, slack)
        return out

    def one_group(group, qi, xi, q, x, exact, top, q_ids, ids, to_pivot, q_to_pivot, slack):
        bound = np.zeros((len(group), len(x)), np.float32)
        for p, distance in enumerate(to_pivot.astype(np.float32)):
            np.maximum(bound, np.abs(distance - q_to_pivot[group, p, None].astype(np.float32)), out=bound)
        least = bound.min(0)
        order = np.argsort(least, kind="stable")
        length = (q[group] * q[group]).sum(1) + top  # squared distance = length - 2 * product
        best = [np.empty(0, np.int64)] * len(group)
        scores = [np.empty(0, np.int64)] * len(group)
        worst = np.full(len(group), -np.inf)  # the k-th best product, once there are k
        for start in range(0, len(order), STEP):
            part = order[start:start + STEP]
            reach = np.sqrt(np.maximum(length - 2 * worst, 0)) + slack
            if (least[part[0]] > reach).all():
                break
            if exact:
                found = q[group] @ x[part].T
            else:
                found = np.array([[sum(int(u) * int(v) for u, v in zip(qi[g], xi[c])) for c in part] for g in group], dtype=object)
            for r, g in enumerate(group):
                hit = np.flatnonzero((bound[r, part] <= reach[r]) & (found[r] >= worst[r]) & (ids[part] != q_ids[g]))
                if not len(hit):
                    continue
                rows = np.concatenate([best[r], part[hit]])
                value = np.concatenate([scores[r], found[r][hit].astype(np.int64)])
                keep = np.lexsort((ids[rows], -value))[:k]
                best[r], scores[r] = rows[keep], value[keep]
                if len(keep) == k:
                    worst[r] = value[keep[-1]]
        return [(np.full(len(b), q_ids[g]), ids[b], s) for g, b, s in zip(group, best, scores)]

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 64, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row where ``is_query``, its k highest integer inner products.

    ``is_query`` is over the column ``id``. Candidates are all rows with another id, ties go to the smaller
    id; fewer than k candidates give them all, none gives no rows. Vectors that are NULL, empty, or hold NULL or
    non-finite components take no part; vectors of another length than the query's are no candidates of it.
    Rows that repeat an id are candidates each, and queries once. Other columns are not read. Products must fit
    64 bits. An empty table gives no rows.
    """
    settle(vectors.sparkSession)
    whole = cut_lineage(whole_vectors(vectors, id_col, vector_col, scale))
    length = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    tops = whole.groupBy(F.size("v").alias("dim")).agg(F.max(length).alias("top"))
    queries = _blocks(whole.where(is_query).dropDuplicates(["id"]), QUERY_BLOCK, "q")
    candidates = _blocks(whole, BLOCK, "c", pivots)
    pairs = (queries.select("dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data")).join(tops, "dim")
             .join(candidates.select("dim", "ids", "data", "pivots"), "dim").select("dim", "top", "q_ids", "q_data", "ids", "data", "pivots"))
    found = pairs.repartition(_spread(whole)).mapInArrow(_best(k), "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _spread(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2
