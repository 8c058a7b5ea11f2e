"""Exact top-k inner products by a pivot-distance index.

Vectors become whole numbers, floor(scale * x). With M the greatest norm,
v -> (v, sqrt(M^2 - |v|^2)) and q -> (q, 0) turn the greatest inner product into the nearest
neighbour:
|q - v|^2 = |q|^2 + M^2 - 2 q.v. The index keys every vector by its nearest pivot and its
distance to it, sorts by that key and packs neighbours into annuli of a bounded number of
rows. By the triangle inequality no vector of an annulus [low, high] around pivot p is closer
to q than max(d(q, p) - high, low - d(q, p)), 0 at least.

Queries are packed in the same way. Each block first scans the annuli around its own
place; the k-th distances found are radii, within which annuli are then expanded, nearest bounds
first, in rounds that end at the whole radius. Radii shrink from round to round. Bounds
carry a slack far above rounding, and equal distances are still searched, so ties are exact.

Pivots come from a bounded sample of rows; every row is indexed.

Cases: vectors that are null, or hold null or non-finite components, take no part; shorter
vectors count as filled with zeros; a squared norm of 2**52 or
more, whose sums would not be exact, raises an error;
rows that repeat an id are candidates each, and a query's own id is never its candidate; a
query id that is repeated is asked once, with its least vector;
equal scores go to the smaller id; null ids take no part; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketloom.llm.common import written

SCALE, PIVOTS, SAMPLE, ANNULUS_ROWS, BLOCK_QUERIES = 256, 24, 4096, 512, 128
ROUNDS = (0.5, 0.75, 1.0)
LARGEST = 2.0**52


def whole_numbers(embedding: Column, scale: float = SCALE) -> Column:
    """floor(scale * x) of each component; null for a vector that takes no part."""
    finite = ~F.exists(
        embedding,
        lambda x: F.coalesce(F.isnan(x) | (F.abs(x.cast("double")) == float("inf")), F.lit(True)),
    )
    scaled = F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return F.when(finite, scaled.cast("array<double>"))


def _matrix(rows: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix, filled with zeros."""
    lists = rows.to_pylist()
    out = np.zeros((len(lists), width))
    for i, values in enumerate(lists):
        out[i, : len(values)] = values
    return out


def _lifted(v: np.ndarray, most: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(most - (v * v).sum(axis=1, keepdims=True), 0))
    return np.hstack([v, rest])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _spread_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows far from each other: each next one is the farthest from those before."""
    chosen = [0]
    nearest = _distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(count, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


class Space:
    """What every task knows: pivots, their width, and the greatest squared norm."""

    def __init__(self, pivots: np.ndarray, width: int, most: float):
        self.pivots, self.width, self.most = pivots, width, most

    @property
    def slack(self) -> float:
        return 1e-6 * (1 + self.most**0.5)


def _keyed(batches: Iterable[pa.RecordBatch], space: Space, queries: bool):
    """Nearest pivot and distance of each row; the vector as bytes."""
    for batch in batches:
        v = _matrix(batch["v"], space.width)
        lifted = np.hstack([v, np.zeros((len(v), 1))]) if queries else _lifted(v, space.most)
        d = _distances(lifted, space.pivots)
        near = d.argmin(axis=1) if len(v) else np.empty(0, int)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(near, pa.int32()),
                pa.array(d[np.arange(len(v)), near], pa.float64()),
                batch["vec_id"],
                pa.array([row.tobytes() for row in v.astype("<i4")], pa.binary()),
            ],
            ["pivot", "distance", "vec_id", "v"],
        )


def _packed(batches: Iterable[pa.RecordBatch], rows: int, part: str) -> Iterator[pa.RecordBatch]:
    """Sorted rows as blocks of one pivot and at most ``rows`` rows each."""
    from pyspark import TaskContext

    task, number, held = TaskContext.get().partitionId(), 0, []

    def block():
        nonlocal number
        number += 1
        pivot, distance, ids, v = zip(*held, strict=True)
        held.clear()
        values = [task << 32 | number, pivot[0], min(distance), max(distance), len(ids)]
        arrays = [pa.array([x]) for x in values[:1]] + [pa.array([values[1]], pa.int32())]
        arrays += [pa.array([x], pa.float64()) for x in values[2:4]]
        arrays += [pa.array([values[4]], pa.int32())]
        arrays += [pa.array([np.array(ids, "<i8").tobytes()]), pa.array([b"".join(v)])]
        names = [part, "pivot", "low", "high", "n", "ids", "matrix"]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and (row[0] != held[0][0] or len(held) == rows):
                yield block()
            held.append(row)
    if held:
        yield block()


def _blocks(vectors: DataFrame, space: Space, rows: int, name: str, queries: bool) -> DataFrame:
    """Vectors in order of pivot, distance and id, in written blocks.

    The order is cut into ranges by all three, so copies of one vector spread over tasks.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(space)
    keyed = vectors.mapInArrow(
        lambda b: _keyed(b, shared.value, queries),
        "pivot int, distance double, vec_id long, v binary",
    )
    keyed = written(keyed, "topk-keys")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["pivot", "distance", "vec_id"]
    ordered = keyed.repartitionByRange(parts, *key).sortWithinPartitions(*key)
    schema = f"{name} long, pivot int, low double, high double, n int, ids binary, matrix binary"
    packed = ordered.mapInArrow(lambda b: _packed(b, rows, name), schema)
    return written(packed, f"topk-{name}")


def _around(blocks: Iterable[pa.RecordBatch], space: Space) -> Iterator[pa.RecordBatch]:
    """For each query block and pivot, the range of its queries' distances to the pivot."""
    for batch in blocks:
        for name, matrix in zip(
            batch["query_block"].to_pylist(), batch["matrix"].to_pylist(), strict=True
        ):
            q = np.frombuffer(matrix, "<i4").reshape(-1, space.width).astype(float)
            d = _distances(np.hstack([q, np.zeros((len(q), 1))]), space.pivots)
            k = d.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * k, pa.int64()),
                    pa.array(np.arange(k), pa.int32()),
                    pa.array(d.min(axis=0)),
                    pa.array(d.max(axis=0)),
                ],
                ["query_block", "pivot", "near", "far"],
            )


FOUND = "query_block long, query_id long, vec_id long, score long"
HELD = 200_000


def _scanned(batches: Iterable[pa.RecordBatch], width: int, k: int) -> Iterator[pa.RecordBatch]:
    """The k best of each query among the annuli that this task reads, merged as they come."""
    names = ["query_block", "query_id", "vec_id", "score"]
    held, size = [], 0

    def best() -> list[np.ndarray]:
        block, query, vec, score = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((vec, -score, query))
        block, query, vec, score = block[order], query[order], vec[order], score[order]
        first = np.searchsorted(query, query)
        kept = np.arange(len(query)) - first < k
        return [x[kept] for x in (block, query, vec, score)]

    def batch_of(columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    for batch in batches:
        for name, ids, matrix, query_ids, queries in zip(
            *(
                batch[c].to_pylist()
                for c in ("query_block", "ids", "matrix", "query_ids", "queries")
            ),
            strict=True,
        ):
            own, asked = np.frombuffer(ids, "<i8"), np.frombuffer(query_ids, "<i8")
            by_id = np.argsort(own, kind="stable")
            own = own[by_id]
            v = np.frombuffer(matrix, "<i4").reshape(-1, width)[by_id].astype(float)
            q = np.frombuffer(queries, "<i4").reshape(-1, width).astype(float)
            scores = q @ v.T
            scores[asked[:, None] == own[None, :]] = -np.inf
            take = min(k, len(own))
            edge = np.partition(scores, len(own) - take, axis=1)[:, [len(own) - take]]
            above, tied = scores > edge, scores == edge
            # Of those at the edge the smallest ids, as many as are wanted.
            wanted = take - above.sum(axis=1, keepdims=True)
            chosen = above | (tied & (np.cumsum(tied, axis=1) <= wanted))
            row, col = np.nonzero(chosen & (scores > -np.inf))
            found = (
                np.full(len(row), name),
                asked[row],
                own[col],
                scores[row, col].astype(np.int64),
            )
            held.append(found)
            size += len(row)
            if size > HELD:
                held = [tuple(best())]
                size = len(held[0][0])
                if size > HELD:
                    yield batch_of(list(held[0]))
                    held, size = [], 0
    if held:
        yield batch_of(best())


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query; each query has a few rows for each task."""
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k)


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    scale: float = SCALE,
    pivots: int = PIVOTS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for rows (vec_id, embedding) of both tables."""
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        whole = df.select(
            F.col("vec_id").cast("long"), whole_numbers(F.col("embedding"), scale).alias("v")
        )
        return whole.filter("vec_id IS NOT NULL AND v IS NOT NULL")

    rows = usable(vectors)
    wanted = usable(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    facts = rows.unionByName(wanted).agg(F.max(F.size("v")), F.max(square))
    width, most = facts.first()
    result = "query_id long, rank int, vec_id long, score long"
    if not width:
        return spark.createDataFrame([], result)
    if most >= LARGEST:
        raise ValueError(f"a squared norm of {most:g} is too large for exact sums")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
    taken = _matrix(sample["v"], width)
    chosen = np.zeros((1, width + 1))
    if len(taken):
        chosen = _spread_pivots(_lifted(taken, most), pivots)
    space = Space(chosen, width, most)
    shared = spark.sparkContext.broadcast(space)

    index = _blocks(rows, space, ANNULUS_ROWS, "annulus", False)
    asked = _blocks(wanted, space, BLOCK_QUERIES, "query_block", True)
    around = asked.select("query_block", "matrix").mapInArrow(
        lambda b: _around(b, shared.value),
        "query_block long, pivot int, near double, far double",
    )
    # Everything but the vectors: one row for each annulus, and for each query block and pivot.
    directory = index.select("annulus", "pivot", "low", "high")
    bound = F.greatest(
        F.lit(0.0), F.col("near") - F.col("high"), F.col("low") - F.col("far")
    ).alias("bound")
    pairs = around.join(directory, "pivot").select("query_block", "annulus", bound)

    def scan(pairs: DataFrame) -> DataFrame:
        ask = asked.select(
            "query_block", F.col("ids").alias("query_ids"), F.col("matrix").alias("queries")
        )
        joined = pairs.select("query_block", "annulus").join(ask, "query_block").join(
            index.select("annulus", "ids", "matrix"), "annulus"
        )
        return joined.select("query_block", "ids", "matrix", "query_ids", "queries").mapInArrow(
            lambda b: _scanned(b, width, k), FOUND
        )

    # First the annuli around a block's own place: those of its pivot that hold its distances.
    own = asked.select("query_block", "pivot", F.col("low").alias("l"), F.col("high").alias("h"))
    overlap = (F.col("low") <= F.col("h")) & (F.col("high") >= F.col("l"))
    home = own.join(directory, "pivot").filter(overlap).select("query_block", "annulus")
    best = written(_top(scan(home), k), "topk-found")

    def radii(best: DataFrame) -> DataFrame:
        """The distance within which all of a block's k best must lie; none if some lack k."""
        ends = best.groupBy("query_block", "query_id").agg(
            F.min("score").alias("score"), F.count(F.lit(1)).alias("n")
        )
        norms = asked.select("query_block", "n").withColumnRenamed("n", "asked")
        low = ends.filter(F.col("n") >= k).groupBy("query_block").agg(
            F.min("score").alias("worst"), F.count(F.lit(1)).alias("full")
        )
        return norms.join(low, "query_block", "left").select(
            "query_block",
            F.when(F.col("full") >= F.col("asked"), F.col("worst")).alias("worst"),
        )

    longest = asked.select("query_block", "matrix").mapInArrow(
        lambda b: _longest(b, width), "query_block long, longest double"
    )
    done = written(home, "topk-pairs")
    for share in ROUNDS:
        reach = radii(best).join(longest, "query_block")
        # d^2 = |q|^2 + M^2 - 2 q.v for the longest query and the worst score.
        square = F.greatest(F.lit(0.0), F.col("longest") + most - 2 * F.col("worst"))
        wide = F.when(F.col("worst").isNull(), F.lit(float("inf"))).otherwise(F.sqrt(square))
        radius = wide * F.lit(share) + F.lit(space.slack)
        near = pairs.join(
            reach.select("query_block", radius.alias("radius")), "query_block"
        ).filter("bound <= radius")
        key = ["query_block", "annulus"]
        new = written(near.select(*key).join(done, key, "left_anti"), "topk-pairs")
        merged = best.select("query_block", "query_id", "vec_id", "score").unionByName(scan(new))
        best = written(_top(merged, k), "topk-found")
        done = done.unionByName(new)
    return best.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _longest(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        norms = []
        for matrix in batch["matrix"].to_pylist():
            q = np.frombuffer(matrix, "<i4").reshape(-1, width).astype(float)
            norms.append(float((q * q).sum(axis=1).max()))
        yield pa.RecordBatch.from_arrays(
            [batch["query_block"], pa.array(norms, pa.float64())], ["query_block", "longest"]
        )
