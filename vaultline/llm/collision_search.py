"""Nearest vectors by collision counting: hashing with query-centred windows.

Every vector is projected on ``lines`` random directions; for each direction the projections
of a block of vectors are a sorted array. A query opens a window around its own projection in each
array and counts for every vector in how many windows it lies. Virtual rehashing widens all
windows step by step, so that each step reads only what is new at both ends. A vector whose count
passes the threshold is verified with the exact inner product; a query ends in a block when its
k-th best verified vector lies within the radius that the windows stand for.

The largest inner product is made a nearest neighbour: vectors are divided by the greatest norm
and get one more component that brings them to length one; queries are brought to length one.

Blocks of vectors meet parts of the query set, so a task holds a block and a part, whatever the
tables' sizes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.sources.scratch import keep

LINES = 24
#: Half the width of a window is the radius times this.
HALF_WIDTH = 1.0
#: The share of windows that a vector must lie in to be verified.
THRESHOLD = 0.58
FIRST_RADIUS, WIDEN = 0.9, 1.15
BLOCK_ROWS, PART_ROWS = 16_384, 1_024
SEED = 7


def _usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Ids and vectors as doubles, without those that take no part."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding")
    )
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))


def _best(rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best and all that could tie with them but for rounding."""
    if len(scores) <= k:
        return rows, scores
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    kept = scores >= least - 1e-9 * (1 + abs(least))
    return rows[kept], scores[kept]


def _search(queries: np.ndarray, block: np.ndarray, k: int, greatest: float, skip: np.ndarray) -> Iterator[tuple]:
    """For each query the verified vectors among which its k nearest of the block are: rows and scores."""
    size = block.shape[1]
    unit = block / greatest
    more = np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1)))
    lines = np.random.default_rng(SEED).standard_normal((size + 1, LINES))
    shadows = unit @ lines[:size] + more[:, None] * lines[size]
    order = np.argsort(shadows, axis=0, kind="stable").T.astype(np.int32).copy()
    arrays = np.take_along_axis(shadows.T, order, axis=1)
    norms = np.sqrt((queries * queries).sum(axis=1))
    centres = (queries / norms[:, None]) @ lines[:size]
    least = int(np.ceil(THRESHOLD * LINES))

    radii = [FIRST_RADIUS]
    while radii[-1] < 2:
        radii.append(radii[-1] * WIDEN)
    edges = np.array(radii) * HALF_WIDTH
    lows = np.stack([np.searchsorted(arrays[i], centres[:, i, None] - edges, "left") for i in range(LINES)])
    highs = np.stack([np.searchsorted(arrays[i], centres[:, i, None] + edges, "right") for i in range(LINES)])

    for q, query in enumerate(queries):
        counts = np.zeros(len(block), dtype=np.uint8)
        seen = np.zeros(len(block), dtype=bool)
        seen[skip == q] = True
        rows, scores = np.zeros(0, dtype=np.int64), np.zeros(0)
        low_before = high_before = None
        for step, radius in enumerate(radii):
            low, high = lows[:, q, step].tolist(), highs[:, q, step].tolist()
            for i in range(LINES):
                if low_before is None:
                    counts[order[i, low[i] : high[i]]] += 1
                else:
                    if low[i] < low_before[i]:
                        counts[order[i, low[i] : low_before[i]]] += 1
                    if high[i] > high_before[i]:
                        counts[order[i, high_before[i] : high[i]]] += 1
            low_before, high_before = low, high
            new = np.flatnonzero((counts >= least) & ~seen)
            if len(new):
                seen[new] = True
                rows, scores = _best(np.concatenate([rows, new]), np.concatenate([scores, block[new] @ query]), k)
            if len(scores) >= k:
                best = scores.min()
                if 2 - 2 * best / (greatest * norms[q]) <= radius * radius:
                    break
        else:  # the widest windows: whatever is left is verified, so that few vectors give all of them
            if len(scores) < k:
                new = np.flatnonzero(~seen)
                rows = np.concatenate([rows, new])
        # summed row by row: equal vectors get equal scores wherever they stand
        yield rows, (block[rows] * query).sum(axis=1)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of each query's k nearest vectors found.

    Nearest is the largest inner product of the vectors as given, in double precision; ties go
    to the smaller id, a missing one first. A vector is never found by a query of its own id, nor one without an id by a query without. Vectors that are null,
    empty, zero or hold a null or non-finite component take no part, neither do queries; vectors of
    different lengths don't meet. A query with fewer than k others gets all of them. A repeated
    id is searched once, with the first of its vectors in order of their components, and found as
    often as it occurs. No vectors or no queries give no rows.
    """
    # blocks are dealt by a position written with the row: rows of one id, or of none, are spread as all others
    base = _usable(vectors, vec_id, embedding).withColumn("size", F.size("embedding"))
    base = keep(base.withColumn("position", F.monotonically_increasing_id()), "vectors")
    asked = _usable(queries, vec_id, embedding).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = keep(asked.withColumns({"size": F.size("embedding"), "position": F.monotonically_increasing_id()}), "queries")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    many, greatest = base.agg(F.count("*"), F.max(norm)).first()
    n_blocks = max(1, ceil(many / BLOCK_ROWS))
    n_parts = max(1, ceil(asked.count() / PART_ROWS))
    greatest = float(greatest or 1.0)

    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    of = lambda n, salt: F.pmod(F.xxhash64("position", F.lit(salt)), F.lit(n)).cast("int")
    left = base.select("size", of(n_blocks, 1).alias("block"), spread(n_parts).alias("part"), "vec_id", "embedding")
    right = asked.select("size", spread(n_blocks).alias("block"), of(n_parts, 2).alias("part"), "vec_id", "embedding")

    def matrix(rows: pa.Table) -> np.ndarray:
        values = pc.list_flatten(rows.column("embedding")).to_numpy()
        return values.reshape(len(rows), -1)

    def search(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        names, kinds = ("query_id", "vec_id", "score"), (pa.int64(), pa.int64(), pa.float64())
        if not len(rows) or not len(wanted):
            return pa.table({name: pa.array([], kind) for name, kind in zip(names, kinds)})
        block, ids, asked_ids = matrix(rows), rows.column("vec_id"), wanted.column("vec_id").to_pylist()
        place = {x: at for at, x in enumerate(asked_ids)}
        skip = np.array([place.get(x, -1) for x in ids.to_pylist()])
        order = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
        found, which, scores = [], [], []
        for query, (at, near) in enumerate(_search(matrix(wanted), block, k, greatest, skip)):
            best = np.lexsort((order[at], -near))[:k]
            found.append(at[best])
            which.append(np.full(len(best), query))
            scores.append(near[best])
        # ids are taken by their places, as they are: a missing one stays missing, none becomes a float
        taken = ids.take(pa.array(np.concatenate(found))), wanted.column("vec_id").take(pa.array(np.concatenate(which)))
        return pa.table({"query_id": taken[1], "vec_id": taken[0], "score": pa.array(np.concatenate(scores), pa.float64())})

    keys = ["size", "block", "part"]
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    # Spark keeps the first k of a query in every task before it brings them together.
    nearest_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(nearest_first))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
