"""Exact top-k by inner product with an impact-ordered, score-at-a-time index.

Vectors are integer components. Distinct vectors are dealt to shards; a shard
is an inverted index: for every dimension its postings, cut into segments by
quantised impact. For a query a segment is worth its component times the
segment's extreme value, less the least any vector can get in that dimension,
so every worth is zero or more. Segments are processed in descending worth,
each adding its worth to the accumulators of its vectors. At any time

    accumulator + sum over dimensions of the next unprocessed worth

bounds a vector's score from above, and the exact scores of the vectors that
lead give a threshold. The search stops only when the bound proves that few
vectors can still reach the threshold (or when no segment is left); these
possible members, ties included, are rescored exactly.

Copies of a vector are indexed once with their ``k + 1`` smallest ids: no
other copy can be among anyone's best ``k``. Equal query vectors are searched
once for ``k + 1`` rows, from which each query row drops itself. A task holds
one shard and a share of the queries, which pass in batches; the best rows of
all shards are merged per query by a group limit before the shuffle.

Defined results. A vector that is null or has a null or non-finite component
takes no part, nor does one whose scores a long could not hold (components
above the square root of 2^62 / dimensions). Vectors of different lengths:
missing components count as zero. A null id is no query; as a candidate it
comes after all ids of its score. Repeated rows are candidates each; a query
row leaves out one row equal to itself. Ties go to the smaller id. Fewer than
``k`` candidates: all of them. Very long vectors are indexed whole. Extra
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse.llm import store

SCALE = 256
K = 5
# Long postings make a step of the search cheap; a shard's index takes about 100 MB at 64 dimensions.
SHARD_VECTORS = 65_536
# Queries of a shard beyond this go to further tasks, which build its index again.
QUERY_ROWS = 512
# Impact levels of a dimension.
LEVELS = 16
# Possible members that are rescored rather than narrowed further.
RESCORE = 2_048
# The bound is checked when these shares of the postings are processed.
_CHECKS = (0.5, 0.6, 0.7, 0.78, 0.85, 0.9, 0.95)


class Shard:
    """Inverted index of the rows of an integer matrix."""

    def __init__(self, vectors: np.ndarray, levels: int = LEVELS):
        self.vectors = vectors
        n, dims = vectors.shape
        self.low, self.high = vectors.min(axis=0), vectors.max(axis=0)
        wide = np.maximum(1, -(-(self.high - self.low + 1) // levels))
        level = (vectors - self.low) // wide
        order = np.argsort(level, axis=0, kind="stable")
        self.postings, dim, least, most = [], [], [], []
        for d in range(dims):
            column, values = level[order[:, d], d], vectors[order[:, d], d]
            cuts = np.flatnonzero(np.diff(column, prepend=-1))
            self.postings += np.split(np.ascontiguousarray(order[:, d]), cuts[1:])
            dim.append(np.full(len(cuts), d))
            least.append(np.minimum.reduceat(values, cuts))
            most.append(np.maximum.reduceat(values, cuts))
        self.dim = np.concatenate(dim) if dim else np.zeros(0, dtype=np.int64)
        self.least = np.concatenate(least) if dim else self.dim
        self.most = np.concatenate(most) if dim else self.dim
        self.size = np.fromiter(map(len, self.postings), dtype=np.int64, count=len(self.postings))

    def possible(self, query: np.ndarray, k: int, rescore: int = RESCORE) -> np.ndarray:
        """Rows that can be among the best ``k`` (ties included), proved by the bound."""
        n, dims = self.vectors.shape
        if n <= max(k, rescore) or not dims:
            return np.arange(n)
        q = query[self.dim]
        base = np.minimum(query * self.low, query * self.high)
        worth = np.maximum(q * self.least, q * self.most) - base[self.dim]
        order = np.argsort(-worth, kind="stable")
        ahead = np.zeros(dims, dtype=np.int64)  # next unprocessed worth of each dimension
        np.maximum.at(ahead, self.dim, worth)
        # What follows a segment in its dimension: its worths fall in processing order.
        by_dim = order[np.argsort(self.dim[order], kind="stable")]
        after = np.zeros(len(worth), dtype=np.int64)
        same = self.dim[by_dim[:-1]] == self.dim[by_dim[1:]]
        after[by_dim[:-1][same]] = worth[by_dim[1:][same]]
        left, floor = int(ahead.sum()), int(base.sum())
        total = np.zeros(n, dtype=np.int64)
        done, checks = 0, [int(c * n * dims) for c in reversed(_CHECKS)]
        for s in order.tolist():
            total[self.postings[s]] += worth[s]
            left -= int(worth[s] - after[s])
            done += int(self.size[s])
            if checks and done >= checks[-1]:
                checks.pop()
                lead = np.argpartition(total, n - k)[n - k :]
                threshold = int((self.vectors[lead] @ query).min())
                able = np.flatnonzero(total >= threshold - floor - left)
                if len(able) <= rescore:
                    return able
        lead = np.argpartition(total, n - k)[n - k :]
        return np.flatnonzero(total >= int((self.vectors[lead] @ query).min()) - floor)


def _order(score: Column, vec_id: Column) -> list[Column]:
    return [score.desc(), vec_id.asc_nulls_last()]


def integer_vectors(rows: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): components floor(scale * x) of the rows that take part."""
    v = F.transform(F.col(vec_col), lambda x: F.lit(float(scale)) * x.cast("double"))
    most = F.sqrt(F.lit(float(1 << 62)) / F.greatest(F.size("v"), F.lit(1)))
    valid = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < most - 1))
    found = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull())
    return found.where(valid).select("vec_id", F.transform("v", lambda x: F.floor(x).cast("long")).alias("v"))


def _first(score: np.ndarray, rows: np.ndarray, ids: list, vno: np.ndarray, k: int) -> list[tuple]:
    """Index rows of the ``k`` best scores, all ties at the last of them included, in order."""
    at = np.arange(len(score))
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    pairs = zip(score[at].tolist(), rows[at].tolist())
    return sorted((-s, i is None, i, int(vno[r])) for s, r in pairs for i in ids[r])


def _search(k: int, shard_levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        held: list[pa.RecordBatch] = []
        index: tuple | None = None

        def dense(col: pa.Array, width: int | None = None) -> np.ndarray:
            size = col.value_lengths().to_numpy()
            wide = int(size.max(initial=0)) if width is None else width
            out = np.zeros((len(col), wide), dtype=np.int64)
            inside = np.arange(max(wide, int(size.max(initial=0)))) < size[:, None]
            values = np.zeros(inside.shape, dtype=np.int64)
            values[inside] = col.flatten().to_numpy()
            out[:, : min(wide, values.shape[1])] = values[:, :wide]
            return out

        def build() -> tuple:
            t = pa.Table.from_batches(held).combine_chunks()
            return Shard(dense(t.column("v").combine_chunks()), shard_levels), t.column("vno").to_numpy(), t.column("ids").to_pylist()

        def best(q: pa.RecordBatch) -> pa.RecordBatch:
            shard, vno, ids = index
            out = []
            for no, query in zip(q.column("vno").to_pylist(), dense(q.column("v"), shard.vectors.shape[1])):
                able = shard.possible(query, k)
                score = shard.vectors[able] @ query
                hits = _first(score, able, ids, vno, k)
                out += [(no, -s, i, v) for s, _, i, v in hits[:k]]
            cols = list(zip(*out)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query", "score", "vec_id", "vno"])

        for b in batches:
            marks = list(zip(*(b.column(c).to_pylist() for c in ("shard", "share", "query"))))
            cuts = [0, *(i for i in range(1, len(marks)) if marks[i] != marks[i - 1]), len(marks)]
            for p, q in zip(cuts, cuts[1:]) if marks else ():
                if key != marks[p][:2]:
                    key, held, index = marks[p][:2], [], None
                if not marks[p][2]:
                    held.append(b.slice(p, q - p))
                elif held:
                    index = index or build()
                    yield best(b.slice(p, q - p))

    return run


def top_k(
    rows: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    shard_vectors: int = SHARD_VECTORS,
    query_rows: int = QUERY_ROWS,
    levels: int = LEVELS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the best ``k`` rows of every query row (``is_query`` over vec_id, v)."""
    spark = rows.sparkSession
    store.python_ready(spark)
    vectors = store.write_shared(integer_vectors(rows, id_col, vec_col, scale), "topk-vectors")
    first = Window.partitionBy("v").orderBy(F.col("vec_id").asc_nulls_last())
    few = vectors.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k + 1)
    # Nulls are missing from collect_list, so ids travel in structs.
    ids = F.transform(F.sort_array(F.collect_list(F.struct("_r", "vec_id"))), lambda x: x["vec_id"])
    distinct = few.groupBy("v").agg(ids.alias("ids")).withColumn("vno", F.monotonically_increasing_id())
    distinct = store.write_shared(distinct, "topk-distinct")
    asked = vectors.where(is_query & F.col("vec_id").isNotNull())
    asked = store.write_shared(asked.join(distinct.select("v", "vno"), "v").select(F.col("vec_id").alias("query_id"), "vno"), "topk-queries")
    queries = store.write_shared(distinct.join(asked.select("vno").distinct(), "vno", "left_semi"), "topk-asked")
    shards = max(1, -(-distinct.count() // shard_vectors))
    shares = max(1, -(-queries.count() // query_rows))
    number = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    held = distinct.select(
        F.pmod(F.xxhash64("vno"), F.lit(shards)).cast("int").alias("shard"), F.explode(number(shares)).alias("share"),
        F.lit(False).alias("query"), "vno", "v", "ids",
    )
    passing = queries.select(
        F.explode(number(shards)).alias("shard"), F.pmod(F.xxhash64("vno"), F.lit(shares)).cast("int").alias("share"),
        F.lit(True).alias("query"), "vno", "v", F.lit(None).cast("array<long>").alias("ids"),
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = held.unionByName(passing).repartition(n, "shard", "share").sortWithinPartitions("shard", "share", "query")
    found = tasks.mapInArrow(_search(k + 1, levels), "query long, score long, vec_id long, vno long")
    best = Window.partitionBy("query").orderBy(*_order(F.col("score"), F.col("vec_id")), "vno")
    found = found.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1)
    hits = found.groupBy(F.col("query").alias("vno")).agg(
        F.sort_array(F.collect_list(F.struct("_r", "vec_id", "score", F.col("vno").alias("hit")))).alias("hits")
    )
    told = asked.join(store.write_shared(hits, "topk-hits"), "vno")
    # The query's own row: the first hit with its id and its vector.
    own = F.transform("hits", lambda h: (h["hit"] == F.col("vno")) & h["vec_id"].eqNullSafe(F.col("query_id")))
    told = told.withColumn("_own", F.array_position(own, True))
    others = F.filter("hits", lambda h, i: i + 1 != F.col("_own"))
    told = told.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("_p", "h"))
    return told.select("query_id", (F.col("_p") + 1).cast("int").alias("rank"), "h.vec_id", "h.score")
