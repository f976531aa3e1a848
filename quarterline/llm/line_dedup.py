"""Line dedup: range-partitioned key hashes, secondary sort by document, streamed first holders.

1. Each document yields one row per distinct key of 40 code points or more: 128-bit key hash,
   doc_id and the positions of its lines.
2. These rows are range-partitioned by (hash, doc_id descending) and sorted within partitions. The
   range bounds include the document, so a key that a third of all documents share is dealt over
   many partitions instead of one.
3. A partition is streamed. The first document of a key is its largest holder and keeps its lines;
   at most ``min_docs`` - 1 rows wait until the key is known to be frequent, later rows are decided
   at once. Only the first and the last key of a partition can go on in a neighbour: their rows are
   passed on undecided with one summary per (key, partition), at most two per partition.
4. The summaries (2 x partitions rows) settle the undecided rows.
5. The result is a compressed bitmap of kept lines per document instead of text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterline.llm.common import BLANKS, fingerprint, tasks, text_or_empty, written

_KEYS = "hi long, lo long, doc_id long, fp long, positions array<int>"
_STREAM = ("kind int, hi long, lo long, part int, doc_id long, fp long, positions array<int>, "
           "n_docs long, last_id long")
_STREAM_T = pa.schema([("kind", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64()), ("part", pa.int32()),
                       ("doc_id", pa.int64()), ("fp", pa.int64()), ("positions", pa.list_(pa.int32())),
                       ("n_docs", pa.int64()), ("last_id", pa.int64())])
DECIDED, OPEN, SUMMARY = 0, 1, 2


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_points: int) -> DataFrame:
    """One row per (document, distinct key of at least ``min_points`` code points)."""
    schema = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("doc_id", pa.int64()), ("fp", pa.int64()),
                        ("positions", pa.list_(pa.int32()))])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, ids, fps, pos = [], [], [], []
            for i, f, text in zip(b["doc_id"].to_pylist(), b["fp"].to_pylist(), b["text"]):
                own: dict[bytes, list[int]] = {}
                for p, line in enumerate(text.as_py().split("\n")):
                    key = line.strip(BLANKS)
                    if len(key) >= min_points:  # bytes.lower() changes A-Z only
                        d = hashlib.blake2b(key.encode().lower(), digest_size=16).digest()
                        own.setdefault(d, []).append(p)
                digests += own
                pos += own.values()
                ids += [i] * len(own)
                fps += [f] * len(own)
            h = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            yield pa.record_batch([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(ids, pa.int64()),
                                   pa.array(fps, pa.int64()), pa.array(pos, pa.list_(pa.int32()))], schema=schema)

    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), fingerprint(text).alias("fp"))
    return rows.mapInArrow(keys, _KEYS)


def _streamer(min_docs: int):
    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _STREAM_T.types)], schema=_STREAM_T)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        key, is_first, n_docs, top, last = None, True, 0, None, None
        waiting: list[tuple] = []  # rows of a key that starts here and may still turn out rare

        for b in batches:
            for hi, lo, i, f, p in zip(*(b[c].to_pylist() for c in ("hi", "lo", "doc_id", "fp", "positions"))):
                if (hi, lo) != key:
                    if key is not None and is_first:
                        out.append((SUMMARY, *key, part, top, None, None, n_docs, last))
                        is_first = False
                    key, n_docs, top, last, waiting = (hi, lo), 1, i, i, []
                elif i != last:
                    n_docs, last = n_docs + 1, i
                if is_first:  # a larger holder may stand in an earlier partition
                    out.append((OPEN, hi, lo, part, i, f, p, None, None))
                elif i != top:
                    waiting.append((i, f, p))
                    if n_docs >= min_docs:
                        out.extend((DECIDED, hi, lo, part, *w, None, None) for w in waiting)
                        waiting = []
            if len(out) > 4096:
                yield as_batch(out)
                out = []
        if key is not None:  # the last key may go on in a later partition
            out.append((SUMMARY, *key, part, top, None, None, n_docs, last))
            out.extend((OPEN, *key, part, *w, None, None) for w in waiting)
        if out:
            yield as_batch(out)

    return stream


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_points: int = 40,
                  min_docs: int = 5) -> DataFrame:
    """(doc_id, fp, positions) of lines that go; a document may have several rows."""
    spark = docs.sparkSession
    keys = written(line_keys(docs, id_col, text_col, min_points), "line-keys")
    order = ["hi", "lo", F.desc_nulls_last("doc_id"), "fp"]
    streamed = written(keys.repartitionByRange(tasks(spark), *order).sortWithinPartitions(*order)
                       .mapInArrow(_streamer(min_docs), _STREAM), "line-stream")
    by_part = Window.partitionBy("hi", "lo").orderBy("part")
    again = F.lag("last_id").over(by_part).eqNullSafe(F.col("doc_id")) & F.lag("part").over(by_part).isNotNull()
    verdict = (streamed.filter(F.col("kind") == SUMMARY)
               .withColumn("_n", F.col("n_docs") - again.cast("long"))
               .groupBy("hi", "lo").agg(F.sum("_n").alias("_docs"), F.max("doc_id").alias("_top"))
               .filter(F.col("_docs") >= min_docs).select("hi", "lo", "_top"))
    # at most two summaries per partition of the sorted table
    settled = (streamed.filter(F.col("kind") == OPEN).join(F.broadcast(verdict), ["hi", "lo"])
               .filter(~F.col("doc_id").eqNullSafe(F.col("_top"))))
    cols = ["doc_id", "fp", "positions"]
    return streamed.filter(F.col("kind") == DECIDED).select(*cols).unionByName(settled.select(*cols))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_points: int = 40,
                 min_docs: int = 5) -> DataFrame:
    """(doc_id, fp, n_lines, n_dropped, keep_bitmap): zlib-compressed bits, one per line, 1 = kept.

    A line's key is the line without white space at both ends, A-Z in lower case. Keys of at least
    ``min_points`` code points found in at least ``min_docs`` documents lose all lines except those
    of the largest doc_id that holds them. Null or empty text is one empty line. A null doc_id counts
    as one document smaller than all others. Rows that repeat a doc_id count as one document; ``fp``
    tells their texts apart, and equal rows share one bitmap.
    """
    drops = (dropped_lines(docs, id_col, text_col, min_points, min_docs)
             .groupBy("doc_id", "fp").agg(F.array_distinct(F.flatten(F.collect_list("positions"))).alias("drop")))
    text = text_or_empty(text_col)
    lines = (docs.select(F.col(id_col).cast("long").alias("doc_id"), fingerprint(text).alias("fp"),
                         (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
                         .alias("n_lines"))
             .groupBy("doc_id", "fp").agg(F.first("n_lines").alias("n_lines")))
    lines = lines.withColumnsRenamed({"doc_id": "_i", "fp": "_f"})
    j = lines.join(drops, F.col("_i").eqNullSafe(F.col("doc_id")) & (F.col("_f") == F.col("fp")), "left")

    def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = []
            for n, d in zip(b["n_lines"].to_pylist(), b["drop"]):
                keep = np.ones(n, dtype=bool)
                if d.is_valid:
                    keep[d.values.to_numpy(zero_copy_only=False)] = False
                packed.append(zlib.compress(np.packbits(keep).tobytes(), 1))
            n_drop = [len(d) if d.is_valid else 0 for d in b["drop"]]
            yield pa.record_batch([b["_i"], b["_f"], b["n_lines"], pa.array(n_drop, pa.int64()),
                                   pa.array(packed, pa.binary())],
                                  names=["doc_id", "fp", "n_lines", "n_dropped", "keep_bitmap"])

    return (j.select("_i", "_f", "n_lines", "drop")
            .mapInArrow(bitmaps, "doc_id long, fp long, n_lines long, n_dropped long, keep_bitmap binary"))


def kept_lines(text: str, n_lines: int, bitmap: bytes) -> str:
    """The text that a bitmap leaves."""
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8), count=n_lines)
    lines = text.split("\n")
    return "\n".join(lines[i] for i in np.flatnonzero(keep))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text): the bitmaps are the small side of a shuffled hash join."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("_i"), text.alias("text"), fingerprint(text).alias("_f"))
    j = rows.join(bitmaps.hint("shuffle_hash"), F.col("_i").eqNullSafe(F.col("doc_id")) & (F.col("_f") == F.col("fp")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [t.as_py() if not d else kept_lines(t.as_py(), n, m.as_py())
                   for t, n, d, m in zip(b["text"], b["n_lines"].to_pylist(), b["n_dropped"].to_pylist(),
                                         b["keep_bitmap"])]
            yield pa.record_batch([b["doc_id"], b["n_lines"], b["n_dropped"], pa.array(out, pa.string())],
                                  names=["doc_id", "n_lines", "n_dropped", "kept_text"])

    return (j.select("doc_id", "text", "n_lines", "n_dropped", "keep_bitmap")
            .mapInArrow(cut, "doc_id long, n_lines long, n_dropped long, kept_text string"))
