"""Exact top-k search by distributed histogram selection.

Queries go in blocks of bounded size; every block is scored against all rows. Score histograms
per query are merged over all tasks and narrowed until the k-th score is known, then rows at or
above it are kept. Where many rows tie at it, the same selection runs over their ids. A task
leaves out only buckets below those in which its own rows already reach k, so the merged
histograms hold all that counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import staged

K, SCALE, EVERY = 20, 64, 20
#: Bytes of the query vectors in one block, and their number: what the driver and each task hold.
BLOCK_BYTES, BLOCK_ROWS = 8 << 20, 4096
BUCKETS = 1024
#: Rows scored at once.
TILE = 512
#: Ties beyond k that may reach the last sort of a query.
SLACK = 64
#: Scores saturate here; reached only by vectors with components beyond some 10**7.
LIMIT = 2**62 - 1
OWN = np.iinfo(np.int64).min


def quantised(batch: pa.RecordBatch, scale: int = SCALE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, floor(scale * x) as doubles) per vector length; without null or non-finite parts."""
    ids, vectors = batch.column("id"), batch.column("vector")
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    start = np.cumsum(lengths) - lengths
    whole = vectors.is_valid().to_numpy(zero_copy_only=False) & ids.is_valid().to_numpy(zero_copy_only=False)
    numbers = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    for n in np.unique(lengths[whole]):
        rows = np.flatnonzero(whole & (lengths == n))
        x = flat[start[rows][:, None] + np.arange(n)]
        finite = np.isfinite(x).all(axis=1)
        with np.errstate(over="ignore"):
            q = np.floor(scale * x[finite])
        yield numbers[rows[finite]], np.clip(q, -1e300, 1e300)


def _scores(queries: np.ndarray, rows: np.ndarray, bound: float) -> np.ndarray:
    """Integer inner products, exact: doubles hold them below 2**53, else Python's integers do."""
    if bound < 2**53:
        return (queries @ rows.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m], dtype=object).reshape(m.shape)
    product = whole(queries).dot(whole(rows).T) if queries.shape[1] else np.zeros((len(queries), len(rows)), object)
    return np.clip(product, -LIMIT, LIMIT).astype(np.int64)


def _tiles(batches, block: dict, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query numbers, ids, scores) tile by tile; a query's own row has the score OWN."""
    for batch in batches:
        for ids, rows in quantised(batch, scale):
            if (found := block.get(rows.shape[1])) is None:
                continue
            numbers, queries, own, bound = found
            order = np.argsort(own)
            for at in range(0, len(ids), TILE):
                part = ids[at : at + TILE]
                s = _scores(queries, rows[at : at + TILE], bound)
                place = np.minimum(np.searchsorted(own[order], part), len(own) - 1)
                for column in np.flatnonzero(own[order][place] == part):
                    s[own == part[column], column] = OWN
                yield numbers, part, s


def top_k(
    vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row with an id divisible by `every` its k best rows.

    Ties go to the smaller id. Rows with a null id, a null vector or a null or non-finite component
    take no part; vectors of other lengths than the query's are not scored. A row with the query's
    own id is no candidate. A repeated row is a candidate each time, but one query only: the
    smallest vector of its id. Fewer candidates than k give all. An empty table gives none.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("vector"))

    def measured(batches):
        for batch in batches:
            for ids, m in quantised(batch, scale):
                if len(ids):
                    size = float(np.sqrt(np.square(m).sum(axis=1)).max()) if m.shape[1] else 0.0
                    yield pa.RecordBatch.from_pydict({"n": [m.shape[1]], "norm": [min(size, 1e300)], "low": [ids.min()], "high": [ids.max()]})

    spans = (
        rows.mapInArrow(measured, "n long, norm double, low long, high long")
        .groupBy("n").agg(F.max("norm").alias("norm"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
    )
    empty = "query_id long, rank int, vec_id long, score long"
    if not spans:
        return spark.createDataFrame([], empty)
    norms = {r["n"]: r["norm"] for r in spans}
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    asked = rows.where((F.col("id") % every == 0) & finite).groupBy("id").agg(F.min("vector").alias("vector"))
    width = max(1, max(norms))
    blocks = max(1, math.ceil(asked.count() / max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * width)))))
    asked = staged(asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))), "topk-queries")
    parts = []
    for number in range(blocks):
        held = asked.where(F.col("block") == number).select("id", "vector").toArrow().combine_chunks()
        found = [x for b in held.to_batches() for x in quantised(b, scale)]
        if sum(len(ids) for ids, _ in found):
            parts.append(staged(_block(rows, found, norms, spans, k, scale), "topk-found"))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], empty)


def _block(rows: DataFrame, found: list, norms: dict, spans: list, k: int, scale: int) -> DataFrame:
    block, start = {}, 0
    for n in {m.shape[1] for _, m in found}:
        ids = np.concatenate([i for i, m in found if m.shape[1] == n])
        m = np.concatenate([m for _, m in found if m.shape[1] == n])
        own_norm = float(np.sqrt(np.square(m).sum(axis=1)).max()) if n else 0.0
        block[n] = (np.arange(start, start + len(ids)), m, ids, own_norm * norms[n] + 1)
        start += len(ids)
    reach = np.zeros(start, dtype=object)
    for numbers, m, _, _ in block.values():
        own = np.sqrt(np.square(m).sum(axis=1)) if m.shape[1] else np.zeros(len(m))
        reach[numbers] = [min(LIMIT, int(min(x * norms[m.shape[1]], 1e19)) + 2) for x in own]
    reach = reach.astype(np.int64)
    shared = rows.sparkSession.sparkContext.broadcast(block)
    key = lambda part, s, cut: s
    low, need, count = _select(rows, shared, scale, -reach, reach, np.full(start, k), key, None)
    # Ties at the k-th score: ids up to a bound that leaves at most SLACK of them too many.
    first, last = min(r["low"] for r in spans), max(r["high"] for r in spans)
    tied = np.flatnonzero(count > need + SLACK)
    bound = np.full(start, last)
    if len(tied):
        by_id = lambda part, s, cut: np.where(s == cut, -part[None, :], OWN)
        wanted = np.where(count > need + SLACK, need, 0)
        down, _, _ = _select(rows, shared, scale, np.full(start, -last), np.full(start, -first), wanted, by_id, low)
        bound[tied] = -down[tied]
    cuts = rows.sparkSession.sparkContext.broadcast((low, bound))

    def kept(batches):
        score, limit = cuts.value
        for numbers, part, s in _tiles(batches, shared.value, scale):
            cut = score[numbers][:, None]
            q, c = np.nonzero((s != OWN) & ((s > cut) | ((s == cut) & (part[None, :] <= limit[numbers][:, None]))))
            if len(q):
                own = shared.value[_length(shared.value, numbers)][2]
                yield pa.RecordBatch.from_arrays([pa.array(own[q]), pa.array(part[c]), pa.array(s[q, c])], ["query_id", "vec_id", "score"])

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        rows.mapInArrow(kept, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _length(block: dict, numbers: np.ndarray) -> int:
    return next(n for n, x in block.items() if x[0][0] == numbers[0])


def _select(rows, shared, scale, low, high, need, key, cut):
    """(value, rank within it, rows at it) of the need-th largest key per query; low where there are fewer.

    Brackets from low to high are cut into BUCKETS and narrowed to the bucket of the need-th key.
    """
    spark = rows.sparkSession
    low, high, need = low.copy(), high.copy(), need.copy()
    count = np.zeros(len(low), dtype=np.int64)
    active = need > 0
    while active.any():
        width = np.maximum(1, -(-(high - low + 1) // BUCKETS))
        state = spark.sparkContext.broadcast((low, high, width, need, active, cut))

        def histogram(batches, state=state):
            low, high, width, need, active, cut = state.value
            held: dict[int, np.ndarray] = {}
            for numbers, part, s in _tiles(batches, shared.value, scale):
                sums = held.setdefault(int(numbers[0]), np.zeros((len(numbers), BUCKETS), dtype=np.int64))
                x = key(part, s, None if cut is None else cut[numbers][:, None])
                lo, hi = low[numbers][:, None], high[numbers][:, None]
                inside = (x >= lo) & (x <= hi) & (s != OWN) & active[numbers][:, None]
                q, c = np.nonzero(inside)
                slot = q * BUCKETS + (x[q, c] - low[numbers][q]) // width[numbers][q]
                sums += np.bincount(slot, minlength=sums.size).reshape(sums.shape)
            for first, sums in held.items():
                upto = np.cumsum(sums[:, ::-1], axis=1)[:, ::-1]
                q, b = np.nonzero((sums > 0) & (upto - sums < need[first : first + len(sums)][:, None]))
                yield pa.RecordBatch.from_arrays([pa.array((q + first).astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(sums[q, b])], ["q", "b", "n"])

        merged = rows.mapInArrow(histogram, "q int, b int, n long").groupBy("q", "b").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("q").orderBy(F.desc("b"))
        reached = (
            merged.withColumn("upto", F.sum("n").over(down))
            .groupBy("q").agg(F.collect_list(F.struct("b", "n", "upto")).alias("all"))
            .toPandas()
        )
        alive = np.zeros(len(low), dtype=bool)
        for q, found in zip(reached["q"], reached["all"], strict=True):
            hit = max((x for x in found if x["upto"] >= need[q]), key=lambda x: x["b"], default=None)
            if hit is None:
                continue
            need[q] -= hit["upto"] - hit["n"]
            low[q] += hit["b"] * width[q]
            high[q] = min(high[q], low[q] + width[q] - 1)
            count[q] = hit["n"]
            alive[q] = high[q] > low[q]
        active = active & alive
    return low, need, count


#: The same in SQL, over the quantised vectors.
ORACLE_SQL = """
WITH whole AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
