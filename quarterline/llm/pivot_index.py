"""Embedding near-dedup with a pivot-permutation index.

Pivots are a bounded sample of the vectors, thinned so that no two have a cosine of ``APART`` or more:
members of a dense group share the same few pivots, however large the group. Every vector is described by the ordered list of its
``nearest`` closest pivots and entered in the inverted list of each of them. Two vectors are
candidates if they share at least ``shared`` pivots; a candidate pair is verified by its cosine in
double precision. A pair that meets in several lists is settled in the list of the smallest pivot
it shares, so links are counted once.

Equal vectors form a class, represented once and weighted by its size, so copies are never compared
with each other. A long list is cut into blocks of ``block`` vectors and each pair of blocks is a
group of its own: no group is larger than two blocks. Groups return per vector its number of links
and its smallest neighbour within reach, not pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import smallest, written
from quarterline.llm.components import connected_components

COSINE = 0.9
NEAREST, SHARED = 12, 2
APART = 0.8
BLOCK = 2_048
MAX_PIVOTS = 16_384


def unit_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, dim, key, vec): vectors of length one as little-endian doubles and their 128-bit digest;
    key and vec are null for vectors that link with nothing."""
    schema = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("key", pa.binary()), ("vec", pa.binary())])

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vecs = []
            for v in b["vec"]:
                x = None
                if v.is_valid and v.values.null_count == 0 and len(v.values):
                    x = v.values.to_numpy(zero_copy_only=False).astype("<f8")
                    top = np.abs(x).max()
                    if np.isfinite(x).all() and top > 0:
                        x = x / top  # no overflow in the sum of squares
                        x = (x / np.sqrt((x * x).sum())).tobytes()
                    else:
                        x = None
                vecs.append(x)
            keys = [None if v is None else hashlib.blake2b(v, digest_size=16).digest() for v in vecs]
            dims = [None if v is None else len(v) // 8 for v in vecs]
            yield pa.record_batch([b["vec_id"], pa.array(dims, pa.int32()), pa.array(keys, pa.binary()),
                                   pa.array(vecs, pa.binary())], schema=schema)

    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
            .mapInArrow(unit, "vec_id long, dim int, key binary, vec binary"))


def _matrix(col) -> np.ndarray:
    vecs = col.to_pylist()
    return np.frombuffer(b"".join(vecs), "<f8").reshape(len(vecs), -1)


def pick_pivots(classes: DataFrame, limit: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """dim -> (pivot numbers, matrix): the ``limit`` vectors of smallest hash and one of each dimension, thinned."""
    hashed = classes.select("dim", "vec", "key", F.xxhash64("key").alias("order"))
    some = smallest(hashed, "order", limit, "key").collect()
    some += classes.groupBy("dim").agg(F.min_by("vec", "key").alias("vec")).collect()  # one row per dimension
    out, seen = {}, set()
    for r in some:
        if (r.dim, bytes(r.vec)) not in seen:
            seen.add((r.dim, bytes(r.vec)))
            out.setdefault(r.dim, []).append(np.frombuffer(r.vec, "<f8"))
    base, numbered = 0, {}
    for dim in sorted(out):
        kept = _thinned(np.stack(out[dim]))
        numbered[dim] = (np.arange(base, base + len(kept), dtype=np.int32), kept)
        base += len(kept)
    return numbered


def _thinned(p: np.ndarray, apart: float = APART) -> np.ndarray:
    """The vectors in their order, without those that have a cosine of ``apart`` or more with one kept before."""
    kept = np.empty((0, p.shape[1]))
    for lo in range(0, len(p), 512):
        part = p[lo:lo + 512]
        part = part[~(part @ kept.T >= apart).any(axis=1)]
        close = part @ part.T >= apart
        keep = np.zeros(len(part), bool)
        for i in range(len(part)):
            keep[i] = not (close[i, :i] & keep[:i]).any()
        kept = np.concatenate([kept, part[keep]])
    return kept


def _describer(pivots, nearest: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b["dim"].to_numpy()
            for dim in np.unique(dims):
                rows = b.filter(pa.array(dims == dim))
                names, p = pivots.value[dim]
                k = min(nearest, len(names))
                for lo in range(0, rows.num_rows, 1024):
                    part = rows.slice(lo, 1024)
                    near = _matrix(part["vec"]) @ p.T
                    top = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < len(names) else np.tile(np.arange(k), (len(near), 1))
                    top = np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable"), 1)
                    yield pa.record_batch([part["node"], part["n"], part["vec"], pa.array(list(names[top]), pa.list_(pa.int32()))],
                                          names=["node", "n", "vec", "pivots"])
    return describe


def _settle(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, pivot: int, same: bool, cosine: float,
            shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two blocks that are candidates, belong to this list and are linked."""
    near = x @ y.T >= cosine
    if same:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    ok = np.zeros(len(i), bool)
    need = min(shared, px.shape[1])
    for lo in range(0, len(i), 50_000):
        a, b = px[i[lo:lo + 50_000]], py[j[lo:lo + 50_000]]
        both = (a[:, :, None] == b[:, None, :]).any(axis=2)
        first = np.where(both, a, np.iinfo(np.int32).max).min(axis=1)
        ok[lo:lo + 50_000] = (both.sum(axis=1) >= need) & (first == pivot)
    return i[ok], j[ok]


def _reach(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index within reach of each of n points over the pairs (i, j)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _comparer(cosine: float, shared: int):
    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")  # the smallest index is the smallest node
        pivot, bi, bj = (table[c][0].as_py() for c in ("pivot", "bi", "bj"))
        node, n, own = (table[c].to_numpy() for c in ("node", "n", "own"))
        x = _matrix(table["vec"])
        p = np.stack(table["pivots"].to_pylist()).astype(np.int32)
        left = np.flatnonzero(own == bi)
        right = left if bi == bj else np.flatnonzero(own == bj)
        i, j = _settle(x[left], x[right], p[left], p[right], pivot, bi == bj, cosine, shared)
        i, j = left[i], right[j]
        links = np.bincount(i, n[j], len(node)) + np.bincount(j, n[i], len(node))
        root = node[_reach(len(node), i, j)]
        hit = links > 0
        return pa.table({"node": node[hit], "links": links[hit].astype(np.int64), "root": root[hit]})
    return compare


def embedding_links(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE,
                    nearest: int = NEAREST, shared: int = SHARED, block: int = BLOCK,
                    max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Pairs found with a cosine of ``cosine`` or more are linked. Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing, nor do vectors of different lengths. Rows
    that repeat a vector are linked with each other; a null vec_id is never the smallest. The number
    of pivots is 4 * sqrt(distinct vectors), at most ``max_pivots``, so lists grow with the square
    root of the input. An empty table gives an empty result; other columns are not looked at.
    """
    spark = rows.sparkSession
    vecs = written(unit_vectors(rows, id_col, vec_col), "vectors")
    classes = written(vecs.filter("key is not null").groupBy("key", "dim")
                      .agg(F.first("vec").alias("vec"), F.min("vec_id").alias("low_id"), F.count(F.lit(1)).alias("n"))
                      .withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    limit = min(max_pivots, 4 * math.isqrt(classes.count()) + 1)
    pivots = spark.sparkContext.broadcast(pick_pivots(classes, limit))  # at most max_pivots vectors
    described = written(classes.select("node", "n", "dim", "vec").mapInArrow(
        _describer(pivots, nearest), "node long, n long, vec binary, pivots array<int>"), "vector-pivots")
    lists = described.withColumn("pivot", F.explode("pivots"))
    sizes = lists.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    entry = (lists.join(F.broadcast(sizes), "pivot")  # one row per pivot
             .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("pivot", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"),
                     "own", "node", "n", "vec", "pivots"))
    found = written(entry.groupBy("pivot", "bi", "bj").applyInArrow(_comparer(cosine, shared),
                                                                   "node long, links long, root long"), "vector-links")
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = classes.select("key", "node", "n", "low_id").join(links, "node", "left").join(roots, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    low = placed.groupBy("root").agg(F.min("low_id").alias("component_id"))
    answer = written(placed.join(low, "root").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"), "component_id"), "vector-answer")
    j = vecs.select("vec_id", "key").join(answer, "key", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return j.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
