"""Byte-level BPE encoding and decoding.

Words (matches of the split pattern) are encoded once each, not at every occurrence:

1. Spark counts the words of all documents; those that occur often, at most ``frequent`` of them, are
   encoded by higher-order functions: a fold over the word's byte array that merges in each step the
   neighbouring pair of lowest rank, with the rank map as a literal (an array of small maps, found by
   CRC-32). The result, a bounded table, is broadcast.
2. Tasks split each whole text by the pattern, put together the ids of its words, and remember the
   words that are not in the table after folding them in the same way.

Folding every word occurrence, or joining each with the encoded words, is the native alternative; it
costs several times the CPU and disk limits (figures in the README).

Decoding concatenates the byte strings of the ids.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import text_or_empty, written

FREQUENT, LEAST_COUNT, LONGEST = 150_000, 4, 64
BUCKETS = 1 << 16
_NONE = 1 << 30


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """A tiktoken rank file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


# --- the fold as Spark higher-order functions -----------------------------------------------


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """array<map<string,int>>: tokens as strings of one character per byte (ISO-8859-1), by CRC-32."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        name = token.decode("latin-1")
        buckets[zlib.crc32(name.encode()) % BUCKETS][name] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def _rank(ranks: Column, name: Column) -> Column:
    found = F.element_at(ranks[(F.crc32(name) % BUCKETS).cast("int")], name)
    return F.coalesce(found, F.lit(_NONE))


def _folded(ranks: Column, word: Column) -> Column:
    """The word's pieces after all merges: state (pieces p, ranks r of neighbouring pairs)."""
    n = F.length(word)
    none = F.array().cast("array<int>")
    start = F.struct(F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(word, i, F.lit(1))).alias("p"),
                     F.transform(F.sequence(F.lit(1), n - 1), lambda i: _rank(ranks, F.substring(word, i, F.lit(2)))).alias("r"))

    def merge(s: Column, i: Column) -> Column:  # pieces i - 1 and i of array p, at 1-based place i of array r
        p, r = s["p"], s["r"]
        both = F.concat(p[i - 1], p[i])
        left = F.when(i > 1, F.concat(F.slice(r, F.lit(1), i - 2), F.array(_rank(ranks, F.concat(p[i - 2], both))))).otherwise(none)
        right = F.when(i < F.size(r), F.concat(F.array(_rank(ranks, F.concat(both, p[i + 1]))),
                                               F.slice(r, i + 2, F.greatest(F.size(r) - i - 1, F.lit(0))))).otherwise(none)
        rest = F.slice(p, i + 2, F.greatest(F.size(p) - i - 1, F.lit(0)))
        return F.struct(F.concat(F.slice(p, F.lit(1), i - 1), F.array(both), rest).alias("p"), F.concat(left, right).alias("r"))

    def step(s: Column, _: Column) -> Column:
        low = F.array_min(s["r"])
        at = F.array_position(s["r"], low).cast("int")
        return F.when(low < _NONE, F.transform(F.array(at), lambda i: merge(s, i))[0]).otherwise(s)

    return F.aggregate(F.sequence(F.lit(2), n), start, step)["p"]


def word_ids(word: Column, ranks: dict[bytes, int]) -> Column:
    """array<int>: the ids of a word of at least one byte."""
    name = F.decode(F.encode(word, "utf-8"), "ISO-8859-1")
    split = lambda r: F.transform(F.when(F.length(name) > 1, _folded(r, name)).otherwise(F.array(name)),
                                  lambda x: _rank(r, x))
    whole = lambda r: F.when(_rank(r, name) < _NONE, F.array(_rank(r, name))).otherwise(split(r))
    return F.transform(F.array(rank_literal(ranks)), whole)[0]


def frequent_words(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text",
                   frequent: int = FREQUENT) -> DataFrame:
    """(word, ids) of the most frequent words of all documents, at most ``frequent``.

    The words only save work later on; a split that differs in rare characters would change nothing.
    """
    words = docs.select(F.explode(F.regexp_extract_all(text_or_empty(text_col), F.lit(f"({pattern})"), 1)).alias("word"))
    counts = written(words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
                     .filter((F.col("n") >= LEAST_COUNT) & (F.octet_length("word") <= LONGEST)), "bpe-words")
    least, kept = None, 0
    # one row per distinct count above the cut-off, largest first; stops once the bound is reached
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("n")).toLocalIterator():
        if kept + r.k > frequent:
            break
        least, kept = r.n, kept + r.k
    some = counts.filter(F.col("n") >= least) if least else counts.limit(0)
    return some.select("word", word_ids(F.col("word"), ranks).alias("ids"))


# --- the fold inside tasks ------------------------------------------------------------------


def merge_ranked(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word: lowest rank first, leftmost first; n log n in the word's length."""
    if word in ranks:
        return [ranks[word]]
    if len(word) <= LONGEST:
        parts = [word[i:i + 1] for i in range(len(word))]
        pair = [ranks.get(word[i:i + 2], _NONE) for i in range(len(word) - 1)]
        while pair and (low := min(pair)) < _NONE:
            i = pair.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i:
                pair[i - 1] = ranks.get(parts[i - 1] + parts[i], _NONE)
            if i < len(pair):
                pair[i] = ranks.get(parts[i] + parts[i + 1], _NONE)
        return [ranks[p] for p in parts]
    end = list(range(1, len(word) + 1))  # the piece at i is word[i:end[i]]; 0 marks a merged one
    before = list(range(-1, len(word) - 1))
    heap = [(r, i, i + 2) for i in range(len(word) - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not j or j >= len(word) or end[j] != stop:
            continue  # one of the two pieces has changed since
        end[i], end[j] = stop, 0
        if stop < len(word):
            before[stop] = i
            if (r := ranks.get(word[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (h := before[i]) >= 0 and (r := ranks.get(word[h:stop])) is not None:
            heapq.heappush(heap, (r, h, stop))
    out, i = [], 0
    while i < len(word):
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


class ByteEncoder:
    """Encodes texts; remembers up to ``cap`` words besides the frequent ones, in two generations."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, known: dict[str, bytes], cap: int = 500_000):
        import regex
        self.split = regex.compile(pattern).findall
        self.ranks, self.known, self.cap = ranks, known, cap
        self.young, self.old = dict(known), {}
        self.pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, r in ranks.items():
            self.pieces[r] = token

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        words = self.split(text)
        try:
            return b"".join(map(self.young.get, words))
        except TypeError:  # None: a word that is not remembered
            pass
        if len(self.young) > self.cap + len(self.known):
            self.old, self.young = self.young, dict(self.known)
        for w in set(words).difference(self.young):
            ids = self.old.get(w)
            if ids is None:
                ids = np.array(merge_ranked(w.encode(), self.ranks), "<u4").tobytes()
            self.young[w] = ids
        return b"".join(map(self.young.__getitem__, words))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_ENCODERS: dict[tuple, ByteEncoder] = {}


def _encoder(key: tuple, ranks: dict[bytes, int], pattern: str, known: dict[str, bytes]) -> ByteEncoder:
    """One encoder per worker process and table of frequent words; the latest one is kept."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = ByteEncoder(ranks, pattern, known)
    return _ENCODERS[key]


def _known(words: DataFrame) -> dict[str, bytes]:
    """The frequent words, at most ``frequent`` rows, as Arrow: a Row and a list for each take ten times the memory."""
    out = {}
    for b in words.toArrow().to_batches(max_chunksize=10_000):
        at, ids = b["ids"].offsets.to_numpy(), b["ids"].values.to_numpy().astype("<u4")
        out.update((w, ids[i:j].tobytes()) for w, i, j in zip(b["word"].to_pylist(), at[:-1].tolist(), at[1:].tolist()))
    return out


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
               frequent: int = FREQUENT) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (little-endian uint32), decoded (bytes from the ids).

    Every match of ``pattern`` is encoded separately, without special tokens. Null text counts as empty
    and has no ids; rows that repeat are encoded alike; other columns are not looked at.
    """
    spark = docs.sparkSession
    ranks = read_ranks(rank_file)
    known = _known(frequent_words(docs, ranks, pattern, text_col, frequent))
    shared = spark.sparkContext.broadcast((ranks, known))
    name = (shared.id if hasattr(shared, "id") else id(shared), rank_file, len(known))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, known = shared.value
        enc = _encoder(name, ranks, pattern, known)
        for b in batches:
            ids_col, texts, out, size = b["doc_id"], b["text"], [], 0
            for k in range(b.num_rows):
                ids = enc.encode(texts[k].as_py())
                out.append((ids, enc.decode(ids)))
                size += len(ids)
                if size > 8 << 20 or k + 1 == b.num_rows:
                    done = k + 1 - len(out)
                    yield pa.record_batch([ids_col.slice(done, len(out)), pa.array([len(i) // 4 for i, _ in out], pa.int64()),
                                           pa.array([i for i, _ in out], pa.binary()), pa.array([d for _, d in out], pa.binary())],
                                          names=["doc_id", "n_tokens", "ids", "decoded"])
                    out, size = [], 0

    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return text.mapInArrow(code, "doc_id long, n_tokens long, ids binary, decoded binary")
