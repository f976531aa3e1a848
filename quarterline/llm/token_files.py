"""Token files: flat unsigned integers, 64-bit document offsets, memory-mapped.

A set of files covers the documents in ascending doc_id order. Each partition writes three files:
``.bin``  token ids one after the other, uint16 if the vocabulary fits, else uint32 (little-endian);
``.idx``  int64 offsets into the partition's ids, one per document plus the end;
``.doc``  int64 doc_ids (the smallest int64 stands for null).
A partition's base, the ids of all documents before it, is the prefix sum of the partition sizes; a
document's global start is base + local offset. Files appear whole by rename, so a task that runs
again leaves the same file.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterline.llm.common import fingerprint, reachable, shared_input, shared_output, tasks, text_or_empty, written
from quarterline.llm.word_ids import WordEncoder
from quarterline.session import scratch_path

NULL_ID = np.iinfo(np.int64).min
_MANIFEST = "part int, bin string, idx string, doc string, n_docs long, n_ids long, width int"


def write_token_files(docs: DataFrame, encoder: Callable[[], WordEncoder], end_id: int = 1, folder: str | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files of ``docs`` and return their manifest with ``base`` (prefix sum).

    Documents are range-partitioned and sorted by doc_id (null first; rows that repeat an id stand in
    order of a hash of their texts). Null text counts as empty: only the end id. An empty table has an
    empty manifest; other columns are not looked at.
    """
    spark = docs.sparkSession
    reachable(spark)
    folder = folder or scratch_path(spark, "tokens")
    text = text_or_empty(text_col)
    order = ["doc_id", "fp"]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), fingerprint(text).alias("fp"), text.alias("text"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, enc = TaskContext.get().partitionId(), encoder()
        paths = [f"{folder}/part-{part:06d}.{x}" for x in ("bin", "idx", "doc")]
        n_docs, n_ids = 0, 0
        with shared_output(paths[0]) as ids, shared_output(paths[1]) as offsets, shared_output(paths[2]) as names:
            offsets.write(np.zeros(1, "<i8").tobytes())
            for b in (x.slice(k, 1000) for x in batches for k in range(0, x.num_rows, 1000)):
                data, sizes = enc.encode_array(b["text"])
                closed = sizes + 1
                ends = n_ids + np.cumsum(closed, dtype="<i8")
                out = np.full(len(data) + len(sizes), end_id, enc.dtype)
                own = np.ones(len(out), bool)
                own[ends - n_ids - 1] = False  # the places of the end ids
                out[own] = data
                ids.write(out.tobytes())
                offsets.write(ends.tobytes())
                names.write(b["doc_id"].fill_null(int(NULL_ID)).to_numpy().astype("<i8").tobytes())
                n_docs, n_ids = n_docs + len(sizes), int(ends[-1]) if len(sizes) else n_ids
        yield pa.RecordBatch.from_pylist([dict(part=part, bin=paths[0], idx=paths[1], doc=paths[2], n_docs=n_docs,
                                               n_ids=n_ids, width=enc.width)],
                                         schema=pa.schema([("part", pa.int32()), ("bin", pa.string()),
                                                           ("idx", pa.string()), ("doc", pa.string()),
                                                           ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                                                           ("width", pa.int32())]))

    parts = (rows.repartitionByRange(tasks(spark), *order).sortWithinPartitions(*order).mapInArrow(put, _MANIFEST))
    manifest = written(parts, "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    return manifest.filter("n_docs > 0").withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


class TokenFile:
    """One partition's files, opened as arrays over their bytes."""

    def __init__(self, ids, offsets, names, width: int):
        self.ids = np.frombuffer(ids, dtype=f"<u{width}")
        self.offsets = np.frombuffer(offsets, dtype="<i8")
        self.names = np.frombuffer(names, dtype="<i8")

    def __len__(self) -> int:
        return len(self.names)

    def document(self, k: int) -> np.ndarray:
        return self.ids[self.offsets[k]:self.offsets[k + 1]]


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the mapped files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for m in b.to_pylist():
                with shared_input(m["bin"]) as x, shared_input(m["idx"]) as y, shared_input(m["doc"]) as z:
                    f = TokenFile(x, y, z, m["width"])
                    crc = np.fromiter((zlib.crc32(f.document(k).astype("<u4").tobytes()) for k in range(len(f))),
                                      np.int64, len(f))
                    start, size, names = f.offsets[:-1] + m["base"], np.diff(f.offsets), f.names.copy()
                    del f  # the arrays must go before the maps are closed
                for k in range(0, len(names), 10_000):
                    s = slice(k, k + 10_000)
                    yield pa.record_batch([pa.array(names[s], mask=names[s] == NULL_ID), pa.array(start[s]),
                                           pa.array(size[s]), pa.array(crc[s])],
                                          names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.repartition(tasks(manifest.sparkSession), "part").mapInArrow(read, schema)
