"""Ranked lexical search: hybrid of term-at-a-time and document-at-a-time evaluation.

Documents are indexed in blocks (at most ``BLOCK_DOCS`` documents or about ``BLOCK_BYTES`` of text): one row
per block and term with its postings (document places and counts), and one row per block with doc_ids and
sizes. A search shuffles the postings of the items' terms, and nothing else, to the task of their block; no
list of a frequent term is ever in one place. Inside a block, for each item:

1. term at a time: the short lists are summed into accumulators, which become one list with a bound, the
   largest sum; the k-th largest sum is a first threshold;
2. document at a time: windows of documents whose bounds cannot reach the threshold are skipped; in the
   others the lists are ordered by their bounds, those that together stay under the threshold propose no
   documents but are only looked up (a skip to each proposed document), largest bound first, and a document
   is given up as soon as what is left cannot lift it to the threshold.

The threshold grows from block to block within a task. All scores are 64-bit integers and ties are kept
until the last ranking, so the result is that of scoring every document.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterline.llm.common import reachable, tasks, text_or_empty, written
from quarterline.llm.word_ids import stretches, text_buffer

BLOCK_DOCS, BLOCK_BYTES = 1 << 16, 32 << 20
#: Items are searched for in blocks of at most about so much text.
QUERY_BYTES = 1 << 20
#: A list is long if it holds more than this share of a block's documents.
LONG_SHARE = 1 / 32
#: Documents per window of the document-at-a-time pass.
WINDOW = 2048

_TERM = np.array([c >= 0x80 or chr(c).isalnum() for c in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_ROWS = "block long, term binary, n_docs int, docs binary, tfs binary, ids array<long>, sizes array<long>"
_ARROW = pa.schema([("block", pa.int64()), ("term", pa.binary()), ("n_docs", pa.int32()), ("docs", pa.binary()),
                    ("tfs", pa.binary()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))])


def text_terms(text: str | None) -> list[bytes]:
    """The terms of one text: runs of ASCII letters and digits and of all other characters, A-Z lowered."""
    return bytes(_LOWER[c] if _TERM[c] else 32 for c in (text or "").encode()).split()


# --- index ----------------------------------------------------------------------------------


class _Block:
    """Postings of the documents of one block, gathered stretch by stretch."""

    def __init__(self):
        self.ids: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []
        self.found: list[tuple[np.ndarray, pa.DictionaryArray, np.ndarray]] = []
        self.n_docs = self.n_bytes = 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        data, ends = text_buffer(texts)
        sizes = np.zeros(len(texts), np.int64)
        for a, b in stretches(data, ends):
            term = _TERM[data[a:b]]
            fresh = np.zeros(b - a + 1, bool)
            fresh[ends[np.searchsorted(ends, a):np.searchsorted(ends, b)] - a] = True
            begins, stops = term.copy(), term.copy()
            begins[1:] &= ~term[:-1] | fresh[1:-1]
            stops[:-1] &= ~term[1:] | fresh[1:-1]
            starts = np.flatnonzero(begins)
            if not len(starts):
                continue
            bounds = np.zeros(len(starts) + 1, np.int32)
            np.cumsum(np.flatnonzero(stops) + 1 - starts, out=bounds[1:])
            body = _LOWER[data[a:b][term]]
            words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(body)])
            coded = words.dictionary_encode()
            doc = np.searchsorted(ends, starts + a, "right") - 1
            sizes += np.bincount(doc, minlength=len(texts))
            pairs, tf = np.unique((doc << 32) + coded.indices.to_numpy(), return_counts=True)
            code = pa.DictionaryArray.from_arrays(pa.array((pairs & 0xFFFFFFFF).astype(np.int32)), coded.dictionary)
            self.found.append(((pairs >> 32) + self.n_docs, code, tf))
        self.ids.append(ids)
        self.sizes.append(sizes)
        self.n_docs += len(texts)
        self.n_bytes += len(data)

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        lists = [pa.array([x], pa.list_(pa.int64())) for x in (pa.concat_arrays(self.ids), np.concatenate(self.sizes))]
        yield pa.record_batch([pa.array([block]), pa.nulls(1, pa.binary()), pa.array([self.n_docs], pa.int32()),
                               pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), *lists], schema=_ARROW)
        if not self.found:
            return
        codes = pa.chunked_array([c for _, c, _ in self.found]).unify_dictionaries()
        terms = codes.chunk(0).dictionary
        order = pc.array_sort_indices(terms)
        place = np.empty(len(terms), np.int64)
        place[order.to_numpy()] = np.arange(len(terms))
        key = np.concatenate([place[c.indices.to_numpy()] << 16 for c in codes.chunks])
        key += np.concatenate([d for d, _, _ in self.found])
        tf = np.concatenate([t for _, _, t in self.found])
        sort = np.argsort(key, kind="stable")
        key, tf = key[sort], tf[sort]
        first = np.flatnonzero(np.diff(key, prepend=-1))  # a document may lie in several stretches
        key, tf = key[first], np.add.reduceat(tf, first)
        at = np.searchsorted(key >> 16, np.arange(len(terms) + 1))
        width = 1 if tf.max() < 1 << 8 else 2 if tf.max() < 1 << 16 else 4

        def packed(values: np.ndarray, size: int) -> pa.Array:
            return pa.Array.from_buffers(pa.binary(), len(terms), [None, pa.py_buffer((at * size).astype(np.int32)),
                                                                   pa.py_buffer(values.astype(f"<u{size}"))])

        n, none = len(terms), pa.nulls(len(terms), pa.list_(pa.int64()))
        whole = pa.record_batch([pa.array(np.full(n, block)), terms.take(order), pa.array(np.diff(at).astype(np.int32)),
                                 packed(key & 0xFFFF, 2), packed(tf, width), none, none], schema=_ARROW)
        for k in range(0, n, 20_000):
            yield whole.slice(k, 20_000)


@dataclass(frozen=True)
class LexicalIndex:
    """``postings`` (block, term, n_docs, docs, tfs), ``blocks`` (block, ids, sizes), and the corpus counts:
    documents with a term, and terms with repeats."""
    postings: DataFrame
    blocks: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_docs: int = BLOCK_DOCS,
                block_bytes: int = BLOCK_BYTES) -> LexicalIndex:
    """Index every whole text of ``docs`` and write the index to the shared folder.

    Null text has no terms; rows that repeat an id are documents of their own; an empty table gives an empty
    index; other columns are not looked at. ``block_docs`` is at most 65,536 (places are 16-bit).
    """
    reachable(docs.sparkSession)
    block_docs = min(block_docs, 1 << 16)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for b in batches:
            k = 0
            while k < b.num_rows:
                part = b.slice(k, min(512, block_docs - block.n_docs))
                block.add(part["doc_id"], part["text"])
                k += part.num_rows
                if block.n_docs >= block_docs or block.n_bytes >= block_bytes:
                    yield from block.rows(number)
                    number, block = number + 1, _Block()
        if block.n_docs:
            yield from block.rows(number)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    index = written(rows.mapInArrow(put, _ROWS), "lexical-index")
    blocks = index.filter("term is null").select("block", "ids", "sizes")
    total = blocks.select(F.size(F.filter("sizes", lambda n: n > 0)).cast("long").alias("n"),
                          F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n).alias("t")).agg(F.sum("n"), F.sum("t")).first()
    return LexicalIndex(index.filter("term is not null").select("block", "term", "n_docs", "docs", "tfs"), blocks,
                        int(total[0] or 0), int(total[1] or 0))


# --- search ---------------------------------------------------------------------------------


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class _List:
    """One term's postings in a block with what each adds to a score, and its bounds."""

    def __init__(self, docs: np.ndarray, adds: np.ndarray, windows: np.ndarray):
        self.docs, self.adds, self.most = docs, adds, int(adds.max())
        cut = np.searchsorted(docs, windows)
        self.cut = cut.tolist()
        self.window_most = np.zeros(len(windows) - 1, np.int64)
        full = np.flatnonzero(np.diff(cut))
        self.window_most[full] = np.maximum.reduceat(adds, cut[full])


class _Best:
    """The k best (score, key) of one item so far; ``least`` is the score a document needs to matter."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores = self.keys = np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, keys: np.ndarray) -> None:
        scores, keys = np.concatenate([self.scores, scores]), np.concatenate([self.keys, keys])
        order = np.lexsort((keys, -scores))[:self.k]
        self.scores, self.keys = scores[order], keys[order]
        if len(order) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


#: Key of a null doc_id: behind all others among equal scores.
_NULL = np.iinfo(np.int64).max


class BlockSearch:
    """Searches one block for items given as (list number, repeats) pairs."""

    def __init__(self, ids: pa.Array, sizes: np.ndarray, n_docs: int, n_terms: int, weights: np.ndarray,
                 window: int = WINDOW, long_share: float = LONG_SHARE):
        self.keys = ids.fill_null(_NULL).to_numpy()
        self.n, self.weights = len(sizes), weights
        if int(sizes.max(initial=0)) * n_docs < 1 << 55:
            share = 75 * sizes * n_docs // max(n_terms, 1)
        else:
            share = np.array([75 * int(s) * n_docs // n_terms for s in sizes], np.int64)
        self.length = 25 + share
        self.windows = np.append(np.arange(0, self.n, window), self.n)
        self.long_from = long_share * self.n
        self.lists: dict[int, _List] = {}

    def put(self, number: int, docs: bytes, tfs: bytes) -> None:
        docs = np.frombuffer(docs, "<u2").astype(np.int64)
        tf = np.frombuffer(tfs, f"<u{len(tfs) // len(docs)}").astype(np.int64)
        adds = int(self.weights[number]) * (1_000_000_000 * tf // (1000 * tf + 8 * self.length[docs]))
        if adds.any():
            self.lists[number] = _List(docs, adds, self.windows)

    def search(self, item: list[tuple[int, int]], best: _Best) -> None:
        have = [(self.lists[t], r) for t, r in item if t in self.lists]
        if not have:
            return
        # term at a time: short lists become accumulators
        short = [(x, r) for x, r in have if len(x.docs) <= self.long_from]
        sums = np.zeros(self.n, np.int64)
        for x, r in short:
            sums[x.docs] += r * x.adds
        # the accumulators and the long lists, smallest bound first: (bound, bounds by window, list or None, repeats)
        parts = [(r * x.most, r * x.window_most, x, r) for x, r in have if len(x.docs) > self.long_from]
        if short:
            sum_most = np.maximum.reduceat(sums, self.windows[:-1])
            parts.append((int(sum_most.max()), sum_most, None, 1))
            held = sums[sums > 0]
            if len(held) >= best.k:  # so many documents score at least their sum
                best.least = max(best.least, int(np.partition(held, len(held) - best.k)[len(held) - best.k]))
        parts.sort(key=lambda p: p[0])
        reach = np.sum([p[1] for p in parts], axis=0)
        for w in range(len(self.windows) - 1):
            if reach[w] >= best.least:
                self._window(w, parts, sums, best)

    def _window(self, w: int, parts: list, sums: np.ndarray, best: _Best) -> None:
        a, b = int(self.windows[w]), int(self.windows[w + 1])
        under, n_passive = 0, 0  # lists that together stay under the threshold propose no documents
        while under + int(parts[n_passive][1][w]) < best.least:
            under += int(parts[n_passive][1][w])
            n_passive += 1
        score = np.zeros(b - a, np.int64)
        for _, _, x, r in parts[n_passive:]:
            if x is None:
                score += sums[a:b]
            else:
                s = slice(x.cut[w], x.cut[w + 1])
                score[x.docs[s] - a] += r * x.adds[s]
        docs = np.flatnonzero((score > 0) & (score + under >= best.least))
        score = score[docs]
        for _, most, x, r in reversed(parts[:n_passive]):
            if not len(docs):
                return
            if x is None:
                score = score + sums[docs + a]
            else:  # skip to each proposed document
                s = slice(x.cut[w], x.cut[w + 1])
                own, adds = x.docs[s], x.adds[s]
                if len(own):
                    at = np.minimum(np.searchsorted(own, docs + a), len(own) - 1)
                    score = score + np.where(own[at] == docs + a, r * adds[at], 0)
            under -= int(most[w])
            keep = score + under >= best.least
            docs, score = docs[keep], score[keep]
        if len(docs):
            best.add(score, self.keys[docs + a])


def _item_block(index: LexicalIndex, rows: list, k: int, window: int, long_share: float) -> DataFrame:
    """Results for the items in ``rows`` (bounded text): (item, doc_id, score) of every task's k best."""
    spark = index.blocks.sparkSession
    counts = [Counter(text_terms(r.text)) for r in rows]
    names = sorted(set().union(*counts))
    number = {t: i for i, t in enumerate(names)}
    terms = F.broadcast(spark.createDataFrame([(bytearray(t), i) for t, i in number.items()], "term binary, number int"))
    wanted = index.postings.join(terms, "term")
    df = dict(wanted.groupBy("number").agg(F.sum("n_docs").alias("df")).collect())  # at most one row per term of the items
    weights = np.array([term_weight(index.n_docs, df.get(i, 0)) for i in range(len(names))], np.int64)
    items = [[(number[t], r) for t, r in c.items() if weights[number[t]] > 0] for c in counts]
    n_docs, n_terms = index.n_docs, index.n_terms
    shared = spark.sparkContext.broadcast((weights, items))

    lists = (wanted.select("block", "number", "docs", "tfs", F.lit(None).cast("array<long>").alias("ids"),
                           F.lit(None).cast("array<long>").alias("sizes"))
             .unionByName(index.blocks.select("block", F.lit(-1).alias("number"), F.lit(None).cast("binary").alias("docs"),
                                              F.lit(None).cast("binary").alias("tfs"), "ids", "sizes")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items = shared.value
        best = [_Best(k) for _ in items]
        block = None

        def finish():
            if block is not None and block.lists:
                for item, b in zip(items, best):
                    block.search(item, b)

        for batch in batches:
            numbers, docs, tfs = batch["number"].to_pylist(), batch["docs"], batch["tfs"]
            for j, t in enumerate(numbers):
                if t < 0:  # a new block begins
                    finish()
                    block = BlockSearch(batch["ids"][j].values, batch["sizes"][j].values.to_numpy(), n_docs, n_terms, weights, window,
                                        long_share)
                elif weights[t] > 0:
                    block.put(t, docs[j].as_py(), tfs[j].as_py())
        finish()
        n = np.array([len(b.keys) for b in best], np.int64)
        keys = np.concatenate([b.keys for b in best] or [np.zeros(0, np.int64)])
        scores = np.concatenate([b.scores for b in best] or [np.zeros(0, np.int64)])
        whole = pa.record_batch([pa.array(np.repeat(np.arange(len(best)), n)), pa.array(keys, mask=keys == _NULL), pa.array(scores)],
                                names=["item", "doc_id", "score"])
        for j in range(0, whole.num_rows, 10_000):
            yield whole.slice(j, 10_000)

    found = (lists.repartition(tasks(spark), "block").sortWithinPartitions("block", "number")
             .mapInArrow(run, "item long, doc_id long, score long"))
    ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], "item long, item_id long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    top = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return top.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def search(index: LexicalIndex, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text",
           query_bytes: int = QUERY_BYTES, window: int = WINDOW, long_share: float = LONG_SHARE) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` documents of highest score above 0, equal scores by
    ascending doc_id (null last).

    Items are taken in blocks of about ``query_bytes`` of text, chosen by a hash; only one block's terms and
    weights are at the driver and broadcast at a time. An item without terms, or whose terms no document
    holds, has no rows; items that repeat an id each have their own rows; no items or no documents give an
    empty table.
    """
    own = items.select(F.col(id_col).cast("long").alias("item_id"), text_or_empty(text_col).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // query_bytes))
    out = None
    for i in range(n_blocks):
        some = own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == i) if n_blocks > 1 else own
        rows = some.collect()  # about query_bytes of text
        if rows:
            found = _item_block(index, rows, k, window, long_share)
            if n_blocks > 1:
                found = written(found, "lexical-found")
            out = found if out is None else out.unionByName(found)
    if out is None:
        return items.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out
