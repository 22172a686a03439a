"""Nearest vectors by exact distance."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vector
from .relational import top_k

#: Vectors of a tile, and the queries and vectors of one matrix product.
TILE, QUERIES, VECTORS = 16_384, 512, 4096
#: Small tables are dealt out over as many tiles, but for so many vectors in each.
LEAST_TILES, LEAST_VECTORS = 32, 256
#: Squared lengths above this may overflow in a product; such rows are always compared exactly.
LONG = 1e300


def nearest(vectors: DataFrame, queries: DataFrame, k: int, distance: Callable[[Column, Column], Column] = vector.euclidean, id_col: str = "vec_id", vec_col: str = "embedding", limit: int = 10_000, tile: int = TILE) -> DataFrame:
    """(query_id, id, distance) of the ``k`` nearest vectors of each query, ties by id, NULL distances last.

    The stated queries meet all vectors, in blocks of about ``limit`` queries by a hash of their ids. For Euclidean
    distances a block meets tiles of about ``tile`` vectors, each pair in one group: matrix products leave the few
    vectors that can be among the ``k`` nearest, and these are compared exactly. For other distances each block is
    broadcast to all vectors. A tile or partition passes on ``k`` rows of a query at most."""
    q = queries.select(F.col(id_col).alias("query_id"), F.col(vec_col).alias("_q"))
    v = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("_v"))
    blocks = max(1, -(-q.count() // limit))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    if distance is vector.euclidean:
        return _first(_euclidean(v, q.withColumn("_block", block), blocks, k, tile), k)

    def found(part: DataFrame) -> DataFrame:
        return _first(v.crossJoin(F.broadcast(part)).select("query_id", "id", F.round(distance(F.col("_v"), F.col("_q")), 6).alias("distance")), k)

    return found(q) if blocks == 1 else reduce(DataFrame.unionAll, [found(q.where(block == n)) for n in range(blocks)])


def _first(scored: DataFrame, k: int) -> DataFrame:
    return top_k(scored, k, [F.col("distance").asc_nulls_last(), F.col("id").asc_nulls_last()], ["query_id"])


def _euclidean(v: DataFrame, q: DataFrame, blocks: int, k: int, tile: int) -> DataFrame:
    """The first ``k`` of each query in each tile. Vectors are shuffled once for each block of queries, queries once for each tile."""
    count = v.count()
    tiles = max(1, -(-count // tile), min(LEAST_TILES, count // LEAST_VECTORS))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    v = v.select("id", _plain(v, "_v"), F.pmod(F.xxhash64("id"), F.lit(tiles)).cast("bigint").alias("_tile"), each(blocks).alias("_block"))
    q = q.select("query_id", _plain(q, "_q"), F.col("_block").cast("bigint"), each(tiles).alias("_tile"))
    schema = T.StructType([T.StructField("query_id", q.schema["query_id"].dataType), T.StructField("id", v.schema["id"].dataType), T.StructField("distance", T.DoubleType())])
    return v.groupBy("_tile", "_block").cogroup(q.groupBy("_tile", "_block")).applyInArrow(lambda a, b: _meet(a, b, max(k, 1)), schema)


def _plain(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    return F.col(name) if kind == T.ArrayType(T.FloatType(), kind.containsNull) else F.col(name).cast("array<double>").alias(name)


def _meet(v: pa.Table, q: pa.Table, k: int) -> pa.Table:
    """The first ``k`` vectors of each query, by rounded distance and id. Vectors of unlike length or with a NULL have no distance."""
    v = v.take(pc.sort_indices(v["id"], null_placement="at_end"))
    (v_dims, v_all), (q_dims, q_all) = _vectors(v["_v"]), _vectors(q["_q"])
    queries, places, distances = [], [], []
    for dim in np.unique(q_dims):
        asked, there = np.flatnonzero(q_dims == dim), np.flatnonzero(v_dims == dim) if dim >= 0 else np.empty(0, np.int64)
        if len(there):
            i, j, d = _closest(v_all(there), q_all(asked), k)
            queries.append(asked[i]), places.append(there[j]), distances.append(pa.array(d))
        if len(there) < k:
            rest = np.flatnonzero((v_dims != dim) | (v_dims < 0))[: k - len(there)]
            queries.append(np.repeat(asked, len(rest))), places.append(np.tile(rest, len(asked))), distances.append(pa.nulls(len(asked) * len(rest), pa.float64()))
    at = lambda x: pa.array(np.concatenate([np.empty(0, np.int64), *x]))
    return pa.table({"query_id": q["query_id"].take(at(queries)), "id": v["id"].take(at(places)), "distance": pa.chunked_array(distances, pa.float64())})


def _vectors(column: pa.ChunkedArray) -> tuple[np.ndarray, Callable[[np.ndarray], np.ndarray]]:
    """The length of each vector, -1 for none and for those with a NULL; and the matrix of given rows of one length."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    dims = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    dims[pc.list_parent_indices(lists).filter(lists.flatten().is_null()).to_numpy(zero_copy_only=False)] = -1
    return dims, lambda rows: lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1 if len(rows) and dims[rows[0]] else 0)


def _kinds(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first row of each kind of equal rows, and the kind of each row."""
    if not m.shape[1]:
        return np.zeros(1, np.int64), np.zeros(len(m), np.int64)
    return np.unique(np.ascontiguousarray(m).view(np.dtype((np.void, m.itemsize * m.shape[1]))).ravel(), return_index=True, return_inverse=True)[1:]


def _ranks(groups: np.ndarray) -> np.ndarray:
    """Places of sorted groups' members, from 0."""
    return np.arange(len(groups)) - np.searchsorted(groups, groups)


def _closest(v: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of ``q``, row of ``v`` and rounded distance of the first ``k`` of each query, ties by the row of ``v``.

    Equal queries are searched once. Of equal vectors only ``k`` can be among the first."""
    of = _kinds(v)[1]
    order = np.argsort(of, kind="stable")
    kept = np.sort(order[_ranks(of[order]) < k])
    first, kind = _kinds(q)
    parts = [(at + i, kept[j], d) for at in range(0, len(first), QUERIES) for i, j, d in [_search(v[kept], q[first[at : at + QUERIES]], k)]]
    i, j, d = (np.concatenate(x) for x in zip(*parts, strict=True))
    begin, n = np.searchsorted(i, kind), np.bincount(i, minlength=len(first))[kind]
    rows = np.repeat(np.arange(len(q)), n)
    taken = begin[rows] + _ranks(rows)
    return rows, j[taken], d[taken]


def _search(v: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As _closest, sorted by query. A vector is left out only if its squared distance by a matrix product is above that of
    the ``k``-th so far by more than the product's rounding errors and two of the last digit kept."""
    i, j, d = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    q2, bound = np.einsum("ij,ij->i", q, q), np.full(len(q), np.inf)
    left = np.column_stack([-2 * q, np.ones(len(q)), q2])
    with np.errstate(all="ignore"):
        for at, w in _slices(v):
            w2 = np.einsum("ij,ij->i", w, w)
            near = left @ np.column_stack([w, w2, np.ones(len(w))]).T
            near[:, ~(w2 < LONG)] = near[~(q2 < LONG)] = np.nan
            error = 4 * (w.shape[1] + 8) * np.finfo(float).eps * (q2 + w2[w2 < LONG].max(initial=0))
            if not at and len(w) >= k:
                bound = np.sqrt(np.maximum(np.partition(near, k - 1, axis=1)[:, k - 1] + error, 0))
            far = near > ((bound * (1 + 1e-9) + 2e-6) ** 2 + error)[:, None]
            x, y = np.nonzero(~far)  # what isn't a number stays
            i, j, d = np.concatenate([i, x]), np.concatenate([j, at + y]), np.concatenate([d, _rounded(_exact(q, w, x, y))])
            order = np.lexsort((j, d, i))
            order = order[_ranks(i[order]) < k]
            i, j, d = i[order], j[order], d[order]
            last = _ranks(i) == k - 1
            bound[i[last]] = d[last]
    return i, j, d


def _slices(v: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    return ((at, v[at : at + VECTORS]) for at in range(0, len(v), VECTORS))


def _exact(q: np.ndarray, w: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of pairs of rows; squares are summed from left to right."""
    total = np.zeros(len(x))
    for a, b in zip(np.ascontiguousarray(q.T), np.ascontiguousarray(w.T), strict=True):
        step = a[x] - b[y]
        total += step * step
    return np.sqrt(total)


def _rounded(d: np.ndarray) -> np.ndarray:
    """Six decimals, halves up; what has no such form stays."""
    up = d * 1e6
    whole = np.floor(up)
    out = (whole + (up - whole >= 0.5)) / 1e6
    return np.where(np.isfinite(out), out, d)
