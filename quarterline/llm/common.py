"""Helpers shared by the training-data operators: tables, scratch tables, shared files."""

from __future__ import annotations

import contextlib
import mmap
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.session import scratch_path

#: The white space of every contract: space and \x09-\x0D.
BLANKS = " \t\n\x0b\x0c\r"


def reachable(spark: SparkSession) -> None:
    """Python workers import this package by name: they get the driver's path to it (on a cluster whose
    machines lack that path, ship the package with --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: later jobs start from
    files that outlive a lost executor instead of repeating the work above them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks(spark: SparkSession) -> int:
    """The shuffle width that the session was sized for."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_or_empty(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """Whole rows in one column ``row`` beside the operator's own columns: no name can clash.
    ``select("row.*")`` brings the rows back."""
    return docs.select(F.struct("*").alias("row"), *[c.alias(k) for k, c in keys.items()])


def fingerprint(text: Column) -> Column:
    """64 bits that tell rows of one repeated doc_id apart when their texts differ."""
    return F.xxhash64(text)


def smallest(df: DataFrame, order: str, n: int, *ties: str) -> DataFrame:
    """The ``n`` rows of smallest 64-bit hash ``order``: a sample of bounded size.

    Of a large table only hashes under a threshold with about 4 n rows below it are sorted (the same
    rows come out), so partitions do not each send n rows to one task.
    """
    total = df.count()
    if total > 8 * n:
        df = df.filter(F.col(order) < F.lit(-(1 << 63) + (1 << 64) * 4 * n // total))
    return df.orderBy(order, *ties).limit(n)


# --- files in the shared folder ------------------------------------------------------------


def _local(path: str) -> str | None:
    """The mounted path of a file: URI or plain path; None for other stores."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    return path if path.startswith("/") else None


@contextlib.contextmanager
def shared_output(path: str):
    """A binary file in the shared folder that appears whole or not at all.

    A task may run twice (lost executor, speculation): each attempt writes a file of its own
    and the last step renames it, so both leave the same bytes under the same name.
    """
    local = _local(path)
    if local:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        own = f"{local}.{uuid.uuid4().hex[:8]}.tmp"
        with open(own, "wb") as f:
            yield f
        os.replace(own, local)
        return
    from pyarrow import fs
    store, inner = fs.FileSystem.from_uri(path)
    store.create_dir(os.path.dirname(inner), recursive=True)
    own = f"{inner}.{uuid.uuid4().hex[:8]}.tmp"
    with store.open_output_stream(own) as f:
        yield f
    store.move(own, inner)


@contextlib.contextmanager
def shared_input(path: str):
    """The bytes of a file in the shared folder: memory-mapped where the folder is mounted."""
    local = _local(path)
    if local:
        if os.path.getsize(local) == 0:  # an empty file cannot be mapped
            yield memoryview(b"")
            return
        with open(local, "rb") as f, mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) as m:
            yield m
        return
    from pyarrow import fs
    store, inner = fs.FileSystem.from_uri(path)
    with store.open_input_file(inner) as f:
        yield f.read_buffer()
