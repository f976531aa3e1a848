"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

A chromosome is a whole packing of one shard's pieces: the bin of every piece. Crossover injects a random
share of the well-filled bins of one parent into the other, whole; bins of the other parent that hold a piece
twice are broken up, and the displaced pieces go by decreasing length to the bins where they fit best. Poorly
filled bins are broken up now and then (mutation).

Spark deals the pieces to shards of about ``SHARD`` by a hash of their row number, so shards are alike and
even. Each shard is packed on several islands at once, one task row each, with populations of their own;
after each round every island sends its elite to the next one (a shuffle by shard and island), and every
round's populations are written to the shared folder. Of a shard's islands the best packing is taken. Bins
that are still open then are broken up across shards and packed again as a next, much smaller level, until
one shard holds what is left. Random numbers follow from shard, island and round, so a task that runs again
gives the same packing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import reachable, tasks, text_or_empty, written
from quarterline.llm.word_ids import WordEncoder

CAPACITY = 2048
SHARD, ISLANDS, ROUNDS = 8192, 4, 3
#: Individuals per island, children per island and round, elites that migrate.
POPULATION, CHILDREN, ELITE = 5, 10, 2
#: A bin is well filled from this share of the capacity on.
WELL = 0.995
_FULL_LEVEL = 15  # sequence ids of pieces that fill a sequence alone
_STATE = "shard long, island int, lengths binary, bins array<binary>, n_bins int, fitness double"


# --- the genetic algorithm on one shard -------------------------------------------------------


def best_fit(lengths: list[int], fills: list[int], capacity: int) -> list[int]:
    """Put pieces in the given order into the open bin with the least room that takes them, else a new one.
    ``fills`` (tokens per bin) is extended; returns the bin of each piece."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: a bin with room r is open
    for b, f in enumerate(fills):
        if f < capacity:
            room[capacity - f].append(b)
            mask |= 1 << capacity - f
    out = []
    for n in lengths:
        fit = mask >> n
        if fit:
            r = n + (fit & -fit).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                mask ^= 1 << r
            fills[b] += n
            r -= n
        else:
            b, r = len(fills), capacity - n
            fills.append(n)
        if r:
            if not room[r]:
                mask |= 1 << r
            room[r].append(b)
        out.append(b)
    return out


class Packing:
    """One individual: ``bin_of`` each piece, tokens per bin, and its rank (fewer bins, then fuller ones)."""

    def __init__(self, bin_of: np.ndarray, lengths: np.ndarray, capacity: int):
        used, self.bin_of = np.unique(bin_of, return_inverse=True)
        self.fills = np.bincount(self.bin_of, weights=lengths, minlength=len(used)).astype(np.int64)
        self.fitness = float(np.mean((self.fills / capacity) ** 2)) if len(used) else 0.0
        self.rank = (len(used), -self.fitness)


def packed_by_best_fit(lengths: np.ndarray, order: np.ndarray, capacity: int) -> Packing:
    bins = np.empty(len(lengths), np.int64)
    bins[order] = best_fit(lengths[order].tolist(), [], capacity)
    return Packing(bins, lengths, capacity)


def crossed(a: Packing, b: Packing, lengths: np.ndarray, capacity: int, r: np.random.Generator, share: float,
            worst: float) -> Packing:
    """``a`` with a ``share`` of the well-filled bins of ``b`` injected; also breaks up a share ``worst`` of the
    bins of ``a``, emptiest first."""
    well = np.flatnonzero(b.fills >= WELL * capacity)
    chosen = np.zeros(len(b.fills), bool)
    chosen[well[r.random(len(well)) < share]] = True
    injected = chosen[b.bin_of]
    broken = np.zeros(len(a.fills), bool)
    broken[a.bin_of[injected]] = True
    open_bins = np.flatnonzero(a.fills < capacity)
    n = min(len(open_bins), 1 + int(worst * len(open_bins)))
    broken[open_bins[np.argsort(a.fills[open_bins], kind="stable")[:n]]] = True
    loose = np.flatnonzero(broken[a.bin_of] & ~injected)
    loose = loose[np.argsort(-lengths[loose], kind="stable")]
    kept = np.flatnonzero(~broken)
    place = np.full(len(a.fills), -1)
    place[kept] = np.arange(len(kept))
    bins = np.where(injected, len(kept) + len(lengths) + b.bin_of, place[a.bin_of])
    fills = a.fills[kept].tolist()
    bins[loose] = best_fit(lengths[loose].tolist(), fills, capacity)
    # bins that best_fit opened are numbered from len(kept) on, under those injected
    return Packing(bins, lengths, capacity)


def evolved(lengths: np.ndarray, population: list[Packing], capacity: int, r: np.random.Generator, population_size: int,
            children: int) -> list[Packing]:
    """The population after ``children`` crossovers, best first; an empty one is begun by best fit, on falling
    lengths and on falling lengths with noise."""
    noise = [0.0, 0.01, 0.05, 0.2, 0.5]
    for k in range(len(population), population_size):
        key = lengths * (1 + noise[k % len(noise)] * r.random(len(lengths)))
        population.append(packed_by_best_fit(lengths, np.argsort(-key, kind="stable"), capacity))
    population.sort(key=lambda p: p.rank)
    for _ in range(children):
        i, j = r.choice(len(population), 2, replace=False) if len(population) > 1 else (0, 0)
        child = crossed(population[i], population[j], lengths, capacity, r, r.uniform(0.05, 0.6), r.choice([0.0, 0.2, 1.0]))
        if child.rank < population[-1].rank and all(child.rank != p.rank for p in population):
            population[-1] = child
            population.sort(key=lambda p: p.rank)
    return population[:population_size]


# --- islands in Spark -------------------------------------------------------------------------


def _evolve(capacity: int, level: int, step: int, population: int, children: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
                own = [Packing(np.frombuffer(x, "<u4").astype(np.int64), lengths, capacity) for x in row["bins"]]
                r = np.random.default_rng([level, step, row["island"], row["shard"]])
                own = evolved(lengths, sorted(own, key=lambda p: p.rank)[:max(population, 1)], capacity, r, population, children)
                yield pa.record_batch([pa.array([row["shard"]]), pa.array([row["island"]], pa.int32()), pa.array([row["lengths"]], pa.binary()),
                                       pa.array([[p.bin_of.astype("<u4").tobytes() for p in own]], pa.list_(pa.binary())),
                                       pa.array([own[0].rank[0]], pa.int32()), pa.array([own[0].fitness])],
                                      names=["shard", "island", "lengths", "bins", "n_bins", "fitness"])
    return run


def _level(items: DataFrame, n_shards: int, level: int, capacity: int, islands: int, rounds: int, population: int, children: int) -> DataFrame:
    """(shard, uids, lengths, bins) of the best packing of every shard of ``items`` (uid, length)."""
    dealt = items.select(F.pmod(F.xxhash64("uid"), F.lit(n_shards)).alias("shard"), "uid", "length")

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.record_batch([pa.array([row["shard"]]),
                                       pa.array([np.array([x["uid"] for x in row["all"]], "<i8").tobytes()], pa.binary()),
                                       pa.array([np.array([x["length"] for x in row["all"]], "<i4").tobytes()], pa.binary())],
                                      names=["shard", "uids", "lengths"])

    shards = (dealt.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("length", "uid"))).alias("all"))
              .mapInArrow(gathered, "shard long, uids binary, lengths binary"))
    shards = written(shards, f"pack-{level}-shards")
    state = shards.select("shard", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "lengths",
                          F.array().cast("array<binary>").alias("bins"))
    for step in range(rounds):
        if step:
            elite = state.select("shard", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.lit(None).cast("binary").alias("lengths"),
                                 F.slice("bins", 1, ELITE).alias("bins"), F.lit(1).alias("guest"))
            state = (state.select("shard", "island", "lengths", "bins", F.lit(0).alias("guest")).unionByName(elite)
                     .groupBy("shard", "island")
                     .agg(F.first("lengths", ignorenulls=True).alias("lengths"),
                          F.sort_array(F.collect_list(F.struct("guest", "bins"))).alias("all"))
                     .select("shard", "island", "lengths", F.flatten(F.transform("all", lambda x: x["bins"])).alias("bins")))
        # a row is much work in few bytes: a width of its own, or the rows would be gathered in one task
        state = state.repartition(min(n_shards * islands, 4 * tasks(items.sparkSession)), "shard", "island")
        state = written(state.mapInArrow(_evolve(capacity, level, step, population, children), _STATE), f"pack-{level}-{step}")
    best = state.groupBy("shard").agg(F.min_by(F.element_at("bins", 1), F.struct("n_bins", -F.col("fitness"), "island")).alias("bins"))
    return shards.join(best, "shard")


def _placed(packed: DataFrame, level: int, capacity: int) -> DataFrame:
    """(uid, length, sequence_id, offset, fill) of the pieces of packed shards."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                uid, length = np.frombuffer(row["uids"], "<i8"), np.frombuffer(row["lengths"], "<i4").astype(np.int64)
                bins = np.frombuffer(row["bins"], "<u4").astype(np.int64)
                order = np.argsort(bins, kind="stable")
                uid, length, bins = uid[order], length[order], bins[order]
                before = np.cumsum(length) - length
                first = np.flatnonzero(np.diff(bins, prepend=-1))
                offset = before - np.repeat(before[first], np.diff(np.append(first, len(bins))))
                fill = np.bincount(bins, weights=length).astype(np.int64)[bins]
                for k in range(0, len(uid), 10_000):
                    s = slice(k, k + 10_000)
                    yield pa.record_batch([pa.array(uid[s]), pa.array(length[s]),
                                           pa.array((level << 58) + (row["shard"] << 20) + bins[s]), pa.array(offset[s]), pa.array(fill[s])],
                                          names=["uid", "length", "sequence_id", "offset", "fill"])

    return packed.mapInArrow(put, "uid long, length long, sequence_id long, offset long, fill long")


def pack_lengths(items: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, islands: int = ISLANDS, rounds: int = ROUNDS,
                 population: int = POPULATION, children: int = CHILDREN) -> DataFrame:
    """(uid, sequence_id, offset) for ``items`` (uid long, unique; length long, 1 to ``capacity``).

    Sequences hold at most ``capacity`` tokens without gaps. Equal lengths, repeated texts and an empty table
    need no care: pieces differ by uid alone.
    """
    reachable(items.sparkSession)
    done = (items.filter(F.col("length") >= capacity)
            .select("uid", F.col("uid").bitwiseOR(F.lit(_FULL_LEVEL << 58)).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    left, level = items.filter(F.col("length") < capacity).select("uid", F.col("length").cast("long").alias("length")), 0
    n = left.count()
    while n:
        n_shards = -(-n // shard)
        placed = written(_placed(_level(left, n_shards, level, capacity, islands, rounds, population, children), level, capacity), f"pack-{level}-placed")
        open_bins = placed.filter(F.col("fill") < F.lit(int(WELL * capacity)))
        n_open = open_bins.count() if n_shards > 1 else 0
        last = n_shards == 1 or n_open > n // 2 or level + 1 == _FULL_LEVEL  # many bins stay open: their pieces do not combine
        closed = placed if last else placed.filter(F.col("fill") >= F.lit(int(WELL * capacity)))
        done = done.unionByName(closed.select("uid", "sequence_id", "offset"))
        if last:
            break
        left, n, level = open_bins.select("uid", "length"), n_open, level + 1
    return done


# --- pieces of documents ------------------------------------------------------------------------


def document_pieces(docs: DataFrame, encoder: Callable[[], WordEncoder], capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(uid, doc_id, piece, start, length, ids): the ids of every document with the end id behind them, as
    little-endian unsigned 32-bit integers, cut every ``capacity`` ids; written to the shared folder.

    Null text counts as empty (the end id alone); rows that repeat are documents of their own (``uid`` tells
    pieces apart); an empty table has no pieces; other columns are not looked at.
    """
    reachable(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    lot = 1 << 20  # ids per batch that goes out

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        uid, enc = TaskContext.get().partitionId() << 36, encoder()
        for b in (x.slice(k, 500) for x in batches for k in range(0, x.num_rows, 500)):
            data, sizes = enc.encode_array(b["text"])
            sizes = sizes + 1
            ends = np.cumsum(sizes)
            ids = np.full(len(data) + len(sizes), end_id, "<u4")
            own = np.ones(len(ids), bool)
            own[ends - 1] = False
            ids[own] = data
            n_of = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), n_of)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_of) - n_of, n_of)
            start = piece * capacity
            length = np.minimum(sizes[doc] - start, capacity)
            at = (ends - sizes)[doc] + start
            per = max(1, lot // capacity)
            for k in range(0, len(doc), per):
                s = slice(k, k + per)
                lo, hi = int(at[k]), int(at[s][-1] + length[s][-1])
                bounds = np.append(at[s], hi) - lo
                yield pa.record_batch([
                    pa.array(uid + np.arange(len(doc[s]))), b["doc_id"].take(pa.array(doc[s])), pa.array(piece[s].astype(np.int32)), pa.array(start[s]),
                    pa.array(length[s]),
                    pa.Array.from_buffers(pa.binary(), len(doc[s]), [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(ids[lo:hi].tobytes())])],
                    names=["uid", "doc_id", "piece", "start", "length", "ids"])
                uid += len(doc[s])

    return written(rows.mapInArrow(put, "uid long, doc_id long, piece int, start long, length long, ids binary"), "pack-pieces")


def pack_documents(docs: DataFrame, encoder: Callable[[], WordEncoder], capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", **search) -> DataFrame:
    """Every piece (see ``document_pieces``) with its ids, sequence_id and offset in the sequence."""
    pieces = document_pieces(docs, encoder, capacity, end_id, id_col, text_col)
    return pieces.join(pack_lengths(pieces.select("uid", "length"), capacity, **search), "uid")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids, pieces): the ids of every sequence put together (at most the capacity), and
    which document and piece stands where in it."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length", "ids")))
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("p"))
    return whole.select("sequence_id", "length",
                        F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
                        F.transform("p", lambda x: x.dropFields("ids")).alias("pieces"))
