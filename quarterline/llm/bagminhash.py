"""Near-duplicate documents: BagMinHash signatures of word-shingle multisets, bands, exact overlap.

Signature. Every shingle with weight w (its count) owns Poisson processes over time and weight: one
on the weight interval (0, 1], one on each dyadic interval (1, 2], (2, 4], ... A process on an
interval of length L yields points at rate m * L, generated in order of time from the shingle's hash
alone; a point names one of m components and a weight level, and counts if that level is at most w.
Component i keeps the earliest point that counts. Two multisets agree in a component with probability
sum(min) / sum(max), their weighted Jaccard similarity. Points later than a horizon of about
(ln m) / total weight cannot win, so a document costs about m ln m points whatever its length; the
horizon is doubled for the few documents with a component still empty.

Pairs. Documents with equal multisets form a class, represented once. Classes that share one of the
bands (5 components each) are candidates. Within a bucket first everything is compared with the
smallest and the largest member; only pairs that are then still in different components are compared
all together, in blocks of ``BLOCK`` members within tasks that return links and no pairs. So a bucket of copies costs a star and not all
its pairs, while no link between different components is left out. A pair is first held against the
signatures (at an estimate below ``FLOOR``, five standard deviations under the threshold, the pair is
out), then its multiset overlap is computed exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import fingerprint, packed, text_or_empty, written
from quarterline.llm.components import component_hints, connected_components

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
FLOOR = 0.62  # five standard deviations of the estimate under the threshold
BLOCK = 512
_M = BANDS * ROWS
_GOLD, _A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _gold(k: int) -> np.uint64:
    """k times the golden-ratio constant, modulo 2^64."""
    return np.uint64(int(_GOLD) * k & 0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0 ** -52


def shingle_multisets(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, counts, bounds): document d owns the sorted distinct hashes bounds[d]:bounds[d + 1].

    Words are white-space separated, in lower case. A text of 1 to ``words`` - 1 words is one shingle.
    """
    split = [t.lower().split() for t in texts]
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    flat = np.array([w for ws in split for w in ws], dtype=object)
    h = pd.util.hash_array(flat, categorize=False).astype(np.uint64) if len(flat) else np.zeros(0, np.uint64)
    ends = np.cumsum(sizes)
    acc = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for k in range(words):
        acc = acc * _GOLD + h[k:k + len(acc)]
    acc = _mix(acc)
    hashes, counts, bounds = [], [], [0]
    for end, n in zip(ends, sizes):
        if n >= words:
            x, c = np.unique(acc[end - n:end - words + 1], return_counts=True)
        elif n:
            short = np.uint64(n)
            with np.errstate(over="ignore"):
                for k in range(end - n, end):
                    short = short * _GOLD + h[k]
            x, c = _mix(np.array([short], np.uint64)), np.ones(1, np.int64)
        else:
            x, c = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        hashes.append(x)
        counts.append(c)
        bounds.append(bounds[-1] + len(x))
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64),
            np.concatenate(counts) if counts else np.zeros(0, np.int64), np.array(bounds, np.int64))


def signatures(hashes: np.ndarray, counts: np.ndarray, bounds: np.ndarray, m: int = _M) -> np.ndarray:
    """(documents, m) uint64: the winning points; documents without shingles have zeros."""
    n_docs = len(bounds) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(bounds))
    key, low, length, weight, own = [_mix(hashes + _GOLD)], [np.zeros(len(hashes))], [np.ones(len(hashes))], [counts], [doc]
    step = 1
    while len(more := np.flatnonzero(counts > step)):  # the dyadic interval (step, 2 * step]
        key.append(_mix(hashes[more] + _gold(step + 1)))
        low.append(np.full(len(more), float(step)))
        length.append(np.full(len(more), float(step)))
        weight.append(counts[more])
        own.append(doc[more])
        step *= 2
    key, low, length, weight, own = map(np.concatenate, (key, low, length, weight, own))
    total = np.bincount(doc, counts, n_docs)
    out = np.zeros((n_docs, m), np.uint64)
    open_docs, horizon = total > 0, (np.log(m) + 3) / np.maximum(total, 1)
    while open_docs.any():
        live = np.flatnonzero(open_docs[own])
        t = np.zeros(len(live))
        place, time, name, k = [], [], [], 0
        while len(live):
            seed = _mix(key[live] + _gold(3 * k + 7))
            t = t - np.log(_unit(seed)) / (m * length[live])
            ok = t < horizon[own[live]]
            live, t, seed = live[ok], t[ok], seed[ok]
            at = _mix(seed + _GOLD)
            comp = (_unit(at) * m).astype(np.int64)
            level = low[live] + np.ceil(_unit(_mix(at + _GOLD)) * length[live])
            hit = level <= weight[live]
            place.append(own[live][hit] * m + comp[hit])
            time.append(t[hit])
            name.append(at[hit])
            k += 1
        place, time, name = np.concatenate(place), np.concatenate(time), np.concatenate(name)
        first = np.full(n_docs * m, np.inf)
        np.minimum.at(first, place, time)
        won = time == first[place]
        flat = out.reshape(-1)
        flat[place[won]] = name[won]
        empty = np.isinf(first).reshape(n_docs, m).any(axis=1)
        open_docs &= empty
        horizon = horizon * 2
    return out


def _pieces(batch: pa.RecordBatch, chars: int = 2_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch of about ``chars`` characters."""
    texts, lo, size = batch["text"].to_pylist(), 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars or i + 1 == len(texts):
            yield batch.slice(lo, i + 1 - lo), texts[lo:i + 1]
            lo, size = i + 1, 0


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in _pieces(batch):
            h, c, at = shingle_multisets(texts)
            sig = signatures(h, c, at)
            acc = np.zeros((len(texts), BANDS), np.uint64)
            for k in range(ROWS):
                acc = _mix(acc + sig[:, k::ROWS] + _GOLD)
            bands = _mix(acc + np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD).view(np.int64)
            small = (sig & np.uint64(0xFF)).astype(np.uint8)
            full = at[1:] > at[:-1]
            cls = [hashlib.blake2b(h[a:b].tobytes() + c[a:b].tobytes(), digest_size=16).digest() if b > a else None
                   for a, b in zip(at[:-1], at[1:])]
            yield pa.record_batch(
                [rows["doc_id"], rows["fp"], pa.array(cls, pa.binary()),
                 pa.array([int(c[a:b].sum()) for a, b in zip(at[:-1], at[1:])], pa.int64()),
                 pa.array([x.tobytes() for x in small], pa.binary()),
                 pa.array([x if f else None for x, f in zip(bands, full)], pa.list_(pa.int64()))],
                names=["doc_id", "fp", "cls", "weight", "sig", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in _pieces(batch):
            h, c, at = shingle_multisets(texts)
            yield pa.record_batch([rows["cls"], pa.array([h[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary()),
                                   pa.array([c[a:b].astype("<i4").tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())],
                                  names=["cls", "hashes", "counts"])


def overlap(h1: np.ndarray, c1: np.ndarray, h2: np.ndarray, c2: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets given as sorted hashes and counts."""
    _, i, j = np.intersect1d(h1, h2, assume_unique=True, return_indices=True)
    both = int(np.minimum(c1[i], c2[j]).sum())
    return both / (int(c1.sum()) + int(c2.sum()) - both)


def _linker(similarity: float):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for h1, c1, h2, c2 in zip(*(b[x] for x in ("ha", "ca", "hb", "cb"))):
                s = overlap(np.frombuffer(h1.as_py(), np.uint64), np.frombuffer(c1.as_py(), "<i4"),
                            np.frombuffer(h2.as_py(), np.uint64), np.frombuffer(c2.as_py(), "<i4"))
                ok.append(s >= similarity)
            yield pa.record_batch([b["a"], b["b"], pa.array(ok, pa.bool_())], names=["a", "b", "linked"])
    return link


def _estimator(floor: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b[s].to_pylist()), np.uint8).reshape(-1, _M) for s in ("sa", "sb"))
                yield b.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= floor))
    return keep


def _candidates(t: pa.Table, similarity: float, floor: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(i, partners, roots) of one group (band, bi, bj): partners of i in other components that may be
    similar enough and share no earlier band with it. The caller may change roots while it goes on."""
    band, bi, bj = (t[c][0].as_py() for c in ("band", "bi", "bj"))
    own, w = t["own"].to_numpy(), t["weight"].to_numpy()
    root = np.unique(np.array(t["root"].to_pylist(), object), return_inverse=True)[1]
    sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint8).reshape(-1, _M)
    bands = np.stack(t["bands"].to_pylist())
    left = np.flatnonzero(own == bi)
    right = left if bi == bj else np.flatnonzero(own == bj)
    for i in left:
        k = right[right > i] if bi == bj else right
        k = k[(root[k] != root[i]) & (np.minimum(w[k], w[i]) >= similarity * np.maximum(w[k], w[i]))]
        k = k[(sig[k] == sig[i]).mean(axis=1) >= floor]
        if len(k):
            k = k[bands[i][(bands[k] == bands[i]).argmax(axis=1)] == band]
        if len(k):
            yield i, k, root


def _streamed(settle):
    """Stream groups (band, bi, bj) that stand together; the open group, at most two blocks, is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if held is not None:
                t = pa.concat_tables([held, t.cast(held.schema)])
            if not t.num_rows:
                continue
            key = [t[c].to_numpy() for c in ("band", "bi", "bj")]
            cut = [0, *(np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1).tolist()]
            for lo, hi in zip(cut[:-1], cut[1:]):
                yield from settle(t.slice(lo, hi - lo))
            held = t.slice(cut[-1]).combine_chunks()
        if held is not None and held.num_rows:
            yield from settle(held)
    return run


def _finder(similarity: float, floor: float):
    """(band, cls) of members with a candidate partner: only these need their multisets."""
    def settle(t: pa.Table) -> Iterator[pa.RecordBatch]:
        hit = np.zeros(t.num_rows, bool)
        for i, k, _ in _candidates(t, similarity, floor):
            hit[i] = hit[k] = True
        if hit.any():
            yield from t.select(["band", "cls"]).filter(pa.array(hit)).combine_chunks().to_batches()
    return _streamed(settle)


def _joiner(similarity: float, floor: float):
    """Links between components of one group; a pair whose components have met meanwhile is passed over."""
    def settle(t: pa.Table) -> Iterator[pa.RecordBatch]:
        cls = t["cls"].to_pylist()
        h = [np.frombuffer(x, np.uint64) for x in t["hashes"].to_pylist()]
        c = [np.frombuffer(x, "<i4") for x in t["counts"].to_pylist()]
        a, b = [], []
        for i, k, root in _candidates(t, similarity, floor):
            for j in k:
                if root[i] != root[j] and overlap(h[i], c[i], h[j], c[j]) >= similarity:
                    a.append(cls[i])
                    b.append(cls[j])
                    root[root == root[j]] = root[i]
        if a:
            yield pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
    return _streamed(settle)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY, floor: float = FLOOR) -> DataFrame:
    """One row per document: doc_id, fp, class_id (smallest doc_id within reach of links), class_size, kept.

    A link joins two documents whose multisets of five-word shingles overlap by ``similarity`` or more
    (weighted Jaccard). Null and empty texts have no shingles: each is a class of its own. The row
    with the smallest doc_id stays (null ids last; of equal ids the smaller text hash; of rows alike
    in both exactly one). An empty table gives an empty result; other columns are not looked at.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), fingerprint(text).alias("fp"), text.alias("text"))
    feats = written(rows.mapInArrow(_features, "doc_id long, fp long, cls binary, weight long, sig binary, "
                                               "bands array<long>"), "bag-features")
    same = (feats.filter("cls is not null").groupBy("cls", "doc_id", "fp")
            .agg(F.count(F.lit(1)).alias("n"), F.first("weight").alias("weight"), F.first("sig").alias("sig"),
                 F.first("bands").alias("bands")))
    classes = written(same.groupBy("cls").agg(
        F.min_by(F.struct("doc_id", "fp", F.col("n").alias("n_alike"), "weight", "sig", "bands"),
                 F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("r"), F.sum("n").alias("n"))
        .select("cls", "n", "r.*"), "bag-classes")

    banded = classes.select(F.explode("bands").alias("band"), "cls")
    # written first: the join below then shuffles its own sides, and AQE may split a hot band's members
    buckets = written(banded.groupBy("band").agg(F.min("cls").alias("low"), F.max("cls").alias("high"),
                                                 F.count(F.lit(1)).alias("n")).filter("n > 1"), "bag-buckets")
    members = written(banded.join(buckets, "band"), "bag-members")
    wanted = members.select("cls").distinct().join(classes.select("cls", "doc_id", "fp"), "cls")
    wanted = wanted.select("cls", F.col("doc_id").alias("_i"), F.col("fp").alias("_f"))
    # several rows may share (doc_id, fp); any of them has the class's text
    sets = written(rows.join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("fp") == F.col("_f")))
                   .select("cls", "text").mapInArrow(_sets, "cls binary, hashes binary, counts binary")
                   .groupBy("cls").agg(F.first("hashes").alias("hashes"), F.first("counts").alias("counts")), "bag-sets")

    def tested(pairs: DataFrame, name: str) -> DataFrame:
        s = classes.select("cls", "weight", "sig")
        p = (pairs.join(s.toDF("a", "wa", "sa"), "a").join(s.toDF("b", "wb", "sb"), "b")
             .filter(F.least("wa", "wb") >= similarity * F.greatest("wa", "wb"))
             .select("a", "b", "sa", "sb").mapInArrow(_estimator(floor), "a binary, b binary"))
        p = written(p, f"bag-{name}-candidates")
        return written(p.join(sets.toDF("a", "ha", "ca"), "a").join(sets.toDF("b", "hb", "cb"), "b")
                       .mapInArrow(_linker(similarity), "a binary, b binary, linked boolean"), f"bag-{name}-tested")

    def star(hub: str) -> DataFrame:
        return (members.filter(F.col("cls") != F.col(hub))
                .select(F.least("cls", hub).alias("a"), F.greatest("cls", hub).alias("b")).distinct())

    seen = tested(star("low").unionByName(star("high").join(buckets.filter("n > 2").select("high").distinct()
                  .withColumnRenamed("high", "b"), "b", "left_semi")).distinct(), "star")
    roots = written(component_hints(seen.filter("linked").select("a", "b")), "bag-roots")
    placed = (members.filter("n > 2").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
              .withColumn("root", F.coalesce("root", "cls")).select("band", "cls", "root"))
    split = placed.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("band")
    rest = written(placed.join(split, "band").join(classes.select("cls", "weight", "sig", "bands"), "cls"), "bag-rest")

    def grouped(rows: DataFrame) -> DataFrame:
        """Members in the pairs of blocks of their bucket, pairs standing together."""
        sizes = rows.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
        group = ["band", "bi", "bj"]
        return (rows.join(sizes, "band").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .withColumn("bi", F.least("own", "other")).withColumn("bj", F.greatest("own", "other"))
                .drop("blocks", "other").repartition(*group).sortWithinPartitions(*group))

    close = written(grouped(rest).mapInArrow(_finder(similarity, floor), "band long, cls binary").distinct(), "bag-close")
    cross = written(grouped(rest.join(close, ["band", "cls"]).join(sets, "cls"))
                    .mapInArrow(_joiner(similarity, floor), "a binary, b binary"), "bag-cross")
    links = seen.filter("linked").select("a", "b").unionByName(cross)
    found = written(connected_components(links), "bag-components")

    groups = (classes.join(found.withColumnRenamed("node", "cls"), "cls", "left")
              .withColumn("root", F.coalesce("root", "cls")))
    best = groups.groupBy("root").agg(
        F.min_by(F.struct("doc_id", "fp", "n_alike"), F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("k"),
        F.sum("n").alias("class_size"))
    answer = written(groups.select("cls", "root").join(best, "root")
                     .select("cls", F.col("k.doc_id").alias("class_id"), F.col("k.fp").alias("_kf"),
                             F.col("k.n_alike").alias("_alike"), "class_size").filter("class_size > 1"), "bag-answer")
    j = feats.select("doc_id", "fp", "cls").join(answer, "cls", "left")
    alone = F.col("class_size").isNull()
    best_row = alone | (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("fp") == F.col("_kf")))
    out = j.select("doc_id", "fp", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                   F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), best_row.alias("kept"),
                   F.coalesce("_alike", F.lit(1)).cast("long").alias("n_alike"))
    ties = F.col("kept") & (F.col("n_alike") > 1)
    cols = out.columns
    tied = (out.filter(ties).groupBy(*cols).agg(F.count(F.lit(1)).alias("_k"))
            .withColumn("_x", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_k"))))
            .withColumn("kept", F.col("_x") == 1).select(*cols))
    return out.filter(~ties).unionByName(tied).drop("n_alike")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents of which one stays per class, with all their columns."""
    stay = (near_duplicates(docs).filter("kept").groupBy("doc_id", "fp").agg(F.count(F.lit(1)).alias("n"))
            .withColumnsRenamed({"doc_id": "stay_id", "fp": "stay_fp"}))
    rows = packed(docs, id=F.col("doc_id").cast("long"), f=fingerprint(text_or_empty("text")))
    j = rows.join(stay.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("f") == F.col("stay_fp")))
    # rows alike in id and text: as many stay as the operator kept (one, or all if they have no words)
    return (j.filter("n = 1").dropDuplicates(["stay_id", "stay_fp"]).select("row.*")
            .unionByName(j.filter("n > 1").select("row.*")))
