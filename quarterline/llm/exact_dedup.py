"""Exact dedup by a tree-merge of sorted digest runs.

Every partition first turns its rows into a run: entries sorted by digest, equal digests folded
into one entry (best row so far, group size). Then the runs are merged in rounds. A shard has an
address of ``rounds`` digits; in round r the shards whose addresses differ only in digit r form a
group of ``fan_in`` partners, and each entry moves to the partner named by the r-th digit of its
digest. At the partner Spark sorts the received runs anew and equal digests are folded again. After the
last round a shard's address is a digest prefix and every digest has met in one place.

However many copies exist, a task sees of one digest at most ``fan_in`` entries from round two on, and in
round one at most one per input partition whose hashed home lies in its group: with more partitions than
shards several share a home. Each shard holds 1/shards of the digests, so nothing is gathered in one task or on the driver.

An entry is identified by the SHA-256 digest, and verified by the length and a second, independent
64-bit hash of the normalised text: rows whose digests agree while these differ never merge.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import BLANKS, packed, tasks, text_or_empty, written

_ENTRY = ("digest binary, check_len long, check_hash long, best_len long, id_null boolean, id long, "
          "n long, n_tied long, home int")
_ENTRY_T = pa.schema([("digest", pa.binary()), ("check_len", pa.int64()), ("check_hash", pa.int64()),
                      ("best_len", pa.int64()), ("id_null", pa.bool_()), ("id", pa.int64()), ("n", pa.int64()),
                      ("n_tied", pa.int64()), ("home", pa.int32())])
def _order() -> list:
    return ["digest", "check_len", "check_hash", F.desc("best_len"), "id_null", "id"]



def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document without its text: id, code points, digest and its verification."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.length(text).cast("long").alias("n_points"),
                       F.translate(text, BLANKS, "").alias("_norm"))
    return rows.select("doc_id", "n_points", F.unhex(F.sha2("_norm", 256)).alias("digest"),
                       F.length("_norm").cast("long").alias("check_len"), F.xxhash64("_norm").alias("check_hash"))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream a sorted run and keep one entry per verified digest; holds one open entry between batches."""
    names = _ENTRY_T.names
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch]).select(names).cast(_ENTRY_T)
        if held is not None:
            t = pa.concat_tables([held, t]).combine_chunks()
        dig = np.array(t["digest"].to_pylist(), dtype=object)
        num = {c: t[c].to_numpy() for c in names[1:]}
        new = np.ones(len(dig), dtype=bool)
        new[1:] = ((dig[1:] != dig[:-1]) | (num["check_len"][1:] != num["check_len"][:-1])
                   | (num["check_hash"][1:] != num["check_hash"][:-1]))
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        best = first[group]
        tied = ((num["best_len"] == num["best_len"][best]) & (num["id_null"] == num["id_null"][best])
                & (num["id"] == num["id"][best]))
        out = t.take(pa.array(first))
        out = out.set_column(names.index("n"), "n", pa.array(np.add.reduceat(num["n"], first), pa.int64()))
        out = out.set_column(names.index("n_tied"), "n_tied",
                             pa.array(np.add.reduceat(num["n_tied"] * tied, first), pa.int64()))
        out = out.cast(_ENTRY_T)
        held = out.slice(len(first) - 1, 1)
        yield from out.slice(0, len(first) - 1).combine_chunks().to_batches()
    if held is not None:
        yield from held.combine_chunks().to_batches()


def merge_runs(rows: DataFrame, shards: int, fan_in: int = 8) -> DataFrame:
    """``digest_rows`` -> one entry per distinct normalised text, after log_fan_in(shards) rounds."""
    rounds = max(1, math.ceil(math.log(max(2, shards), fan_in)))
    fan_in = max(2, math.ceil(shards ** (1 / rounds)))  # no wider than the session asks for
    width = fan_in ** rounds
    runs = (rows.select("digest", "check_len", "check_hash", F.col("n_points").alias("best_len"),
                        F.col("doc_id").isNull().alias("id_null"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                        F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("n_tied"),
                        F.pmod(F.hash(F.spark_partition_id()), F.lit(width)).alias("home"))
            .sortWithinPartitions(*_order()).mapInArrow(_fold, _ENTRY))
    prefix = F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long"), F.lit(width)).cast("int")
    for r in range(rounds):
        place = fan_in ** (rounds - 1 - r)
        # digits 0..r of the address come from the digest, the others from where the entry was
        upper = F.floor(F.col("home") / (place * fan_in)) * (place * fan_in)
        digit = F.pmod(F.floor(prefix / place), F.lit(fan_in)) * place
        runs = runs.withColumn("home", (upper + digit + F.pmod("home", F.lit(place))).cast("int"))
        runs = (runs.repartitionById(width, F.col("home")).sortWithinPartitions(*_order()).mapInArrow(_fold, _ENTRY))
    return runs


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_points, n_tied.

    Texts are equal when identical after deleting white space (space, \\x09-\\x0D). Of equal texts the
    row with the most code points stays, then the one with the smallest doc_id. Null texts count as
    empty, and empty texts form one group. A null doc_id sorts after all others. If rows repeat the
    staying row's doc_id and length, exactly one of them has ``kept`` true. An empty table gives an
    empty result; other columns of ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    rows = written(digest_rows(docs, id_col, text_col), "digest-rows")
    best = written(merge_runs(rows, tasks(spark), fan_in)
                   .filter("n > 1")  # a text without a copy needs no answer from the tree
                   .select("digest", "check_len", "check_hash", "best_len",
                           F.when(~F.col("id_null"), F.col("id")).alias("keep_id"), "n", "n_tied"), "digest-groups")
    # rows are ~80 bytes; AQE splits the row side of a hot digest
    j = rows.join(best, ["digest", "check_len", "check_hash"], "left")
    alone = F.col("n").isNull()
    is_best = alone | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("best_len")))
    out = j.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                   F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), is_best.alias("kept"),
                   F.lower(F.hex("digest")).alias("text_sha256"), "n_points",
                   F.coalesce("n_tied", F.lit(1)).cast("long").alias("n_tied"))
    # repeated rows that tie for staying are alike in every column: count them, keep the first
    ties = F.col("kept") & (F.col("n_tied") > 1)
    cols = out.columns
    tied = (out.filter(ties).groupBy(*cols).agg(F.count(F.lit(1)).alias("_k"))
            .withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_k"))))
            .withColumn("kept", F.col("_i") == 1).select(*cols))
    return out.filter(~ties).unionByName(tied)


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    stay = exact_duplicates(docs, id_col, text_col).filter("kept").select(
        F.col("doc_id").alias("stay_id"), "text_sha256", "n_points", "n_tied")
    text = text_or_empty(text_col)
    rows = packed(docs, id=F.col(id_col).cast("long"), sha=F.sha2(F.translate(text, BLANKS, ""), 256), points=F.length(text))
    j = rows.join(stay.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("stay_id"))
                  & (F.col("sha") == F.col("text_sha256")) & (F.col("points") == F.col("n_points")))
    return (j.filter("n_tied = 1").select("row.*")
            .unionByName(j.filter("n_tied > 1").dropDuplicates(["sha"]).select("row.*")))
