"""Exact top-k inner products over norm-sorted blocks, pruned by residual bounds.

Vectors are rotated onto the right singular vectors of the table (from its Gram matrix, which is as small as the
dimension squared), so the first coordinates carry most of the product.  Candidates are range-partitioned by descending
length and packed into blocks; queries are packed into blocks too.  A query block meets a candidate block in one step:
if the largest product of lengths can't reach the k-th best so far the block is skipped; else partial products over the
first coordinates plus the Cauchy-Schwarz bound on the rest decide which pairs are multiplied out.  Products that are
reported are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

K, QUERY_MODULUS, FACTOR = 5, 50, 256
#: Vectors in a candidate block and in a query block; rotated coordinates in the partial product; candidates per step.
BLOCK, QUERY_BLOCK, HEAD, STEP = 4096, 1024, 24, 512
#: Groups of candidate blocks: each query block is sent once to each.
GROUPS = 16


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", factor: int = FACTOR) -> DataFrame:
    """id, dim, v (floor(factor * x) as bigints), len2 for vectors without null or non-finite components."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    ok = F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & (F.size(vec_col) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(x * factor))
    q = vectors.where(ok).select(F.col(id_col).cast("long").alias("id"), F.size(vec_col).alias("dim"), whole.alias("v"))
    return q.withColumn("len2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Right singular vectors by dimension, from Gram matrices summed up partition by partition."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            dims = b.column("dim").to_numpy()
            rows = b.column("v")
            flat, off = rows.values.to_numpy(zero_copy_only=False).astype(np.float64), rows.offsets.to_numpy()
            for d in np.unique(dims):
                at = np.nonzero(dims == d)[0]
                x = np.stack([flat[off[i] : off[i + 1]] for i in at])
                total[int(d)] = total.get(int(d), 0) + x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([g.ravel().tolist() for g in total.values()], pa.list_(pa.float64()))], names=["dim", "g"])

    parts = vectors.select("dim", "v").mapInArrow(gram, "dim int, g array<double>")
    summed = parts.select("dim", F.posexplode("g").alias("i", "x")).groupBy("dim", "i").agg(F.sum("x").alias("x"))
    out: dict[int, np.ndarray] = {}
    for r in summed.groupBy("dim").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("g")).toLocalIterator():
        g = np.array([c["x"] for c in r["g"]]).reshape(r["dim"], r["dim"])
        out[r["dim"]] = np.linalg.eigh(g)[1][:, ::-1].copy()
    return out


def _pack(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[int], list[np.ndarray]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, rows = held.pop(dim)
            x = np.stack(rows)
            order = np.argsort(-(x.astype(np.float64) ** 2).sum(1), kind="stable")
            ids = np.array(ids, np.int64)[order]
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([int(ids.min()) ^ (len(ids) << 40)], pa.int64()), pa.array([ids.tobytes()], pa.binary()), pa.array([x[order].tobytes()], pa.binary())], names=["dim", "name", "ids", "x"])

        for b in batches:
            rows = b.column("v")
            flat, off = rows.values.to_numpy(zero_copy_only=False).astype(np.int64), rows.offsets.to_numpy()
            for i, (key, dim) in enumerate(zip(b.column("id").to_pylist(), b.column("dim").to_pylist(), strict=True)):
                ids, xs = held.setdefault(dim, ([], []))
                ids.append(key)
                xs.append(flat[off[i] : off[i + 1]])
                if len(ids) == size:
                    yield block(dim)
        for dim in list(held):
            yield block(dim)

    return run


def _best(q_ids, q, qr, c_ids, c, cr, k, floor, best):
    """Merge the best k of one candidate block into best (id -> list of (-score, vec id)); floor: k-th best so far."""
    q_len, q_tail = np.linalg.norm(qr, axis=1), np.linalg.norm(qr[:, HEAD:], axis=1)
    c_tail = np.linalg.norm(cr[:, HEAD:], axis=1)
    c_len = np.linalg.norm(cr, axis=1)
    for s in range(0, len(c), STEP):
        e = slice(s, s + STEP)
        slack = 1e-6 * (1 + q_len * c_len[s])
        reach = q_len * c_len[s] + slack >= floor  # candidates stand by descending length
        if not reach.any():
            return
        rows = np.nonzero(reach)[0]
        bound = qr[rows, :HEAD] @ cr[e, :HEAD].T + np.outer(q_tail[rows], c_tail[e]) + slack[rows, None]
        may = (bound >= floor[rows, None]) & (q_ids[rows, None] != c_ids[None, e])
        for i in np.nonzero(may.any(1))[0]:
            r, cols = rows[i], s + np.nonzero(may[i])[0]
            score = c[cols] @ q[r]
            got = best[r] + [(-int(x), int(y)) for x, y in zip(score, c_ids[cols], strict=True) if x >= floor[r]]
            best[r] = sorted(got)[:k]
            if len(best[r]) == k:
                floor[r] = -best[r][-1][0]


def top_k(vectors: DataFrame, k: int = K, modulus: int = QUERY_MODULUS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each query (ids divisible by modulus).

    Every row but those of the query's own id is a candidate; equal scores go to the smaller id, and rows that repeat an
    id are candidates each.  Vectors that are null, empty or hold null, NaN or infinite components, and rows with a null
    id, take no part.  A query is compared with vectors of its own dimension.  An empty table gives no rows, and other
    columns are ignored.
    """
    spark = vectors.sparkSession
    rows = materialize(quantised(vectors, id_col, vec_col), "vectors")
    sent = spark.sparkContext.broadcast(rotations(rows))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = "dim int, name bigint, ids binary, x binary"
    blocks = materialize(rows.repartitionByRange(n, F.desc("len2"), F.xxhash64("id")).sortWithinPartitions(F.desc("len2")).select("id", "dim", "v").mapInArrow(_pack(BLOCK), packed), "blocks")
    asked = rows.where(F.col("id") % modulus == 0).select("id", "dim", "v").distinct()
    queries = materialize(asked.repartition(n, "id").mapInArrow(_pack(QUERY_BLOCK), packed), "queries")
    left = queries.select("dim", "name", F.col("ids").alias("q_ids"), F.col("x").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1))).alias("g"))
    right = blocks.select("dim", "ids", "x", F.pmod(F.xxhash64("name"), F.lit(GROUPS)).cast("int").alias("g"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = sent.value
        name, state = None, None

        def done():
            q_ids, best = state[0], state[3]
            out = [(int(a), y, -x) for a, b in zip(q_ids, best, strict=True) for x, y in b]
            cols = list(zip(*out, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

        for b in batches:
            for dim, key, q_ids, q, ids, x in zip(*(b.column(c).to_pylist() for c in ("dim", "name", "q_ids", "q", "ids", "x")), strict=True):
                if (dim, key, q_ids) != name:
                    if state:
                        yield done()
                    name = (dim, key, q_ids)
                    qi, qx = np.frombuffer(q_ids, np.int64), np.frombuffer(q, np.int64).reshape(-1, dim)
                    state = (qi, qx, qx.astype(np.float64) @ turn[dim], [[] for _ in qi], np.full(len(qi), -np.inf))
                c_ids, c = np.frombuffer(ids, np.int64), np.frombuffer(x, np.int64).reshape(-1, dim)
                _best(state[0], state[1], state[2], c_ids, c, c.astype(np.float64) @ turn[dim], k, state[4], state[3])
        if state:
            yield done()

    # Few rows, each a block: the join pairs blocks within a group, and sorting brings a query block's pairs together.
    pairs = left.join(right, ["dim", "g"]).select("dim", "name", "q_ids", "q", "ids", "x", "g").repartition(n, "g", "dim", "name").sortWithinPartitions("g", "dim", "name", "q_ids")
    partial = pairs.select("dim", "name", "q_ids", "q", "ids", "x").mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    order = F.struct((-F.col("score")).alias("o"), F.col("vec_id").alias("vec_id"))
    merged = partial.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(order)), 1, k).alias("t"))
    return merged.select("query_id", F.posexplode("t").alias("p", "x")).select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.o")).alias("score"))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors by integer inner product of every 50th vector."""
    return top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


OP4_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({FACTOR} * CAST(x AS DOUBLE)) AS BIGINT)) AS v, len(embedding) AS dim FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, q.dim + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.dim = c.dim AND q.vec_id <> c.vec_id WHERE q.vec_id % {QUERY_MODULUS} = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= {K}
"""
