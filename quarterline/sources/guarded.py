"""S9 + S11: guarded scan of per-contract Parquet files as a Python data source.

One partition per file. A file is decoded whole before a row of it comes out, so a file that fails anywhere
(footer, page, missing column, no bytes) gives no rows but one reject row with the reason. The contract is the
``asset=`` folder of a partitioned table, else the file's name. Row groups are read one at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import TARGETS


def _source(files: list[str], time_col: str, target_cols: tuple[str, ...]):
    # the classes are made here so that they travel to the workers by value
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class OneFile(InputPartition):
        def __init__(self, path: str):
            self.path = path

    class Reader(DataSourceReader):
        def partitions(self):
            return [OneFile(f) for f in files] or [OneFile("")]

        def read(self, partition):
            import re
            from urllib.parse import unquote

            import pyarrow as pa
            import pyarrow.parquet as pq
            from pyarrow import fs

            path = partition.path
            if not path:
                return
            folder = re.search(r"/asset=([^/]*)/", path)
            asset = unquote(folder[1]) if folder else unquote(path.rsplit("/", 1)[-1]).split(".")[0]
            out = pa.schema([("path", pa.string()), ("asset", pa.string()), ("ts", pa.timestamp("us", "UTC")),
                             *[(c, pa.float64()) for c in target_cols], ("rows", pa.int64()), ("reason", pa.string())])

            def reject(reason: str):
                row = {"path": path, "asset": asset, "rows": 0, "reason": reason}
                return pa.RecordBatch.from_pylist([row], schema=out)

            def batches(f):
                for b in f.iter_batches(batch_size=50_000, columns=[time_col, *target_cols]):
                    t = b.column(b.schema.get_field_index(time_col))
                    t = t.cast(pa.timestamp("us")) if pa.types.is_timestamp(t.type) and t.type.tz is None else t
                    yield t.cast(pa.timestamp("us", "UTC")), [b.column(b.schema.get_field_index(c)).cast(pa.float64()) for c in target_cols]

            store, inner = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if path.startswith("file:") else path)
            if store.get_file_info(inner).size == 0:
                yield reject("empty file")
                return
            try:
                f = pq.ParquetFile(store.open_input_file(inner), page_checksum_verification=True)
            except (pa.ArrowInvalid, OSError):
                yield reject("unreadable footer")
                return
            missing = [c for c in (time_col, *target_cols) if c not in f.schema_arrow.names]
            if missing:
                yield reject("no column " + ", ".join(missing))
                return
            try:
                n = sum(len(t) for t, _ in batches(f))
            except (pa.ArrowException, OSError, ValueError):
                yield reject("unreadable page")
                return
            yield pa.RecordBatch.from_pylist([{"path": path, "asset": asset, "rows": n}], schema=out)
            none = lambda kind, k: pa.nulls(k, kind)
            for t, values in batches(f):
                k = len(t)
                yield pa.RecordBatch.from_arrays([none(pa.string(), k), pa.array([asset] * k, pa.string()), t, *values, none(pa.int64(), k), none(pa.string(), k)],
                                                 schema=out)

    class GuardedFiles(DataSource):
        @classmethod
        def name(cls):
            return "guarded_files"

        def schema(self):
            return ("path string, asset string, ts timestamp, " + ", ".join(f"`{c}` double" for c in target_cols) + ", rows long, reason string")

        def reader(self, schema):
            return Reader()

    return GuardedFiles


def panel_files(spark: SparkSession, root: str) -> list[str]:
    """Paths of the Parquet files under ``root``, empty ones too (a scan would leave those out): names, not data."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    return sorted(found.inputFiles())


def guarded_scan(spark: SparkSession, root: str, time_col: str = "ts", target_cols: Sequence[str] = TARGETS) -> tuple[DataFrame, DataFrame]:
    """(rows, files): the panel rows of the readable files, and one row per file (path, asset, rows, reason), reason NULL
    where the file was read. The rows of ``rows`` add up to the counts of ``files``."""
    spark.dataSource.register(_source(panel_files(spark, root), time_col, tuple(target_cols)))
    scan = spark.read.format("guarded_files").load()
    files = scan.filter(F.col("path").isNotNull()).select("path", "asset", "rows", "reason")
    return scan.filter(F.col("path").isNull()).select("asset", "ts", *target_cols), files
