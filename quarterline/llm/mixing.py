"""Mixing sources to target weights, in DataFrame and SQL functions only.

1. A document's tokens (its words) get positions in its source: a prefix sum over (bucket, doc_id),
   first of bucket totals, then inside each bucket, so no source is summed in one task.
2. Sources are cut into blocks of ``block_words`` consecutive words.
3. Weights become targets (shares of all words, at most ``max_repeat`` times a source's words) and
   targets become whole numbers of blocks.
4. The output has shards of ``shard_slots`` slots. Each slot draws a source, so a shard's counts are
   multinomial. Counts beyond a source's number of blocks are released, in shard order, to the
   sources that were drawn too rarely; so totals meet the targets and each document's limit.
5. The slots of a source are numbered through all shards. Slot j takes, in pass j div n, the block
   at place j mod n of a pseudorandom permutation of the source's n block numbers (swap-or-not
   rounds, exact for every n), and is joined with the pieces of documents in that block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterline.llm.common import fingerprint, packed, tasks, text_or_empty, written

WORD = r"[^\x20\x09-\x0D]+"
WORD_WITH_BLANKS = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"

BLOCK_WORDS = 64
SHARD_SLOTS = 65_536
MAX_REPEAT = 3
CELLS = 1_024
ROUNDS = 12


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, fp, source, size): documents without their texts."""
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), fingerprint(text).alias("fp"),
                       F.col(source_col).cast("string").alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))


def source_targets(rows: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_no, source_size, weight, target): one row per source.

    Sources by code point, null last, weigh 1, 2, 3, repeating. Filling all targets to one level per
    weight, sources end at ``max_repeat`` times their size in the order of size / weight; the level
    is that of the first source in this order that stays below its limit.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))  # one row per source from here on
    fill = Window.orderBy(F.col("limit") / F.col("weight"), "source_no")
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = (s.withColumn("source_no", F.row_number().over(order))
         .withColumn("weight", (F.col("source_no") - 1) % 3 + 1)
         .withColumn("limit", F.col("source_size") * max_repeat))
    every = Window.partitionBy()
    s = (s.withColumn("_all", F.sum("source_size").over(every))
         .withColumn("_w", F.sum("weight").over(every))
         .withColumn("_limits", F.coalesce(F.sum("limit").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("_weights", F.coalesce(F.sum("weight").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("_level", (F.col("_all") - F.col("_limits")) / (F.col("_w") - F.col("_weights")))
         .withColumn("_free", F.col("limit") / F.col("weight") >= F.col("_level"))
         .withColumn("_level", F.min(F.when(F.col("_free"), F.struct("_limits", "source_no", "_level"))).over(every)["_level"]))
    target = F.least(F.col("limit").cast("double"), F.col("_level") * F.col("weight"))
    return s.select("source", "source_no", F.col("source_size").cast("long").alias("source_size"), "weight",
                    target.cast("double").alias("target"))


def _positions(rows: DataFrame, sources: DataFrame, bucket_rows: int = 5_000) -> DataFrame:
    """Adds source_no and ``start``, the words of the source before the document."""
    buckets = max(1, rows.count() // bucket_rows)
    j = (rows.join(sources.select(F.col("source").alias("_s"), "source_no"), F.col("source").eqNullSafe(F.col("_s")))
         .drop("_s").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "fp"), F.lit(buckets))))
    totals = (j.groupBy("source_no", "bucket").agg(F.sum("size").alias("_sum")).withColumn(
        "_base", F.sum("_sum").over(Window.partitionBy("source_no").orderBy("bucket")) - F.col("_sum")))
    inside = Window.partitionBy("source_no", "bucket").orderBy("doc_id", "fp").rowsBetween(Window.unboundedPreceding, 0)
    return (j.withColumn("_in", F.sum("size").over(inside) - F.col("size"))
            .join(totals.drop("_sum"), ["source_no", "bucket"])
            .withColumn("start", F.col("_base") + F.col("_in")).drop("_base", "_in", "bucket"))


def _quotas(sources: DataFrame, block_words: int) -> DataFrame:
    """Adds n_blocks, quota (blocks to take, at most max_repeat * n_blocks) and low, their running sum."""
    n = F.ceil(F.col("source_size") / block_words)
    q = F.when(F.col("source_size") > 0, F.round(F.col("target") * n / F.col("source_size"))).otherwise(0)
    upto = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    return (sources.withColumn("n_blocks", n.cast("long")).withColumn("quota", q.cast("long"))
            .withColumn("low", F.coalesce(F.sum("quota").over(upto), F.lit(0))))


def draw_counts(quotas: DataFrame, seed: int, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(shard, source_no, n): multinomial draws per shard, settled so that a source's sum is its quota."""
    spark = quotas.sparkSession
    total = quotas.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    cell_size = max(1, -(-total // CELLS))
    # a slot draws a place on the line of all quotas; cells of that line meet by equality
    slots = spark.range(total).select(
        F.floor(F.col("id") / shard_slots).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), "id"), F.lit(max(1, total))).alias("place"))
    lines = (quotas.filter("quota > 0").withColumn("high", F.col("low") + F.col("quota"))
             .withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / cell_size),
                                                      F.floor((F.col("high") - 1) / cell_size)))))
    drawn = (slots.withColumn("cell", F.floor(F.col("place") / cell_size)).groupBy("shard", "cell", "place").count()
             .join(lines.select("cell", "low", "high", "source_no"), "cell")
             .filter((F.col("place") >= F.col("low")) & (F.col("place") < F.col("high")))
             .groupBy("shard", "source_no").agg(F.sum("count").alias("n")))
    by_shard = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    drawn = (drawn.join(quotas.select("source_no", "quota"), "source_no")
             .withColumn("_upto", F.sum("n").over(by_shard))
             .withColumn("keep", F.greatest(F.lit(0), F.least(F.col("n"), F.col("quota") - F.col("_upto") + F.col("n")))))
    drawn = written(drawn.select("shard", "source_no", "n", "keep"), "mix-drawn")
    free = drawn.groupBy("shard").agg(F.sum(F.col("n") - F.col("keep")).alias("n")).filter("n > 0")
    short = (quotas.select("source_no", "quota").join(drawn.groupBy("source_no").agg(F.sum("keep").alias("_k")),
                                                      "source_no", "left")
             .withColumn("n", F.col("quota") - F.coalesce("_k", F.lit(0))).filter("n > 0"))
    # both lists cover the same stretch 0..R: cut it at the ends of either
    ends = (free.select("shard", F.lit(None).cast("int").alias("source_no"),
                        F.sum("n").over(Window.orderBy("shard")).alias("end"))
            .unionByName(short.select(F.lit(None).cast("long").alias("shard"), "source_no",
                                      F.sum("n").over(Window.orderBy("source_no")).alias("end"))))
    line = Window.orderBy("end")
    later = line.rowsBetween(0, Window.unboundedFollowing)
    cut = (ends.groupBy("end").agg(F.max("shard").alias("shard"), F.max("source_no").alias("source_no"))
           .withColumn("n", F.col("end") - F.coalesce(F.lag("end").over(line), F.lit(0)))
           .select(F.first("shard", True).over(later).alias("shard"),
                   F.first("source_no", True).over(later).alias("source_no"), "n"))
    return (drawn.select("shard", "source_no", F.col("keep").alias("n")).unionByName(cut)
            .groupBy("shard", "source_no").agg(F.sum("n").alias("n")).filter("n > 0"))


def _permuted(place: str, n: str, key: str, rounds: int = ROUNDS):
    """Swap-or-not: each round pairs x with (k - x) mod n and swaps by a bit that both agree on."""
    return F.expr(f"""aggregate(sequence(0, {rounds - 1}), {place}, (x, r) ->
        transform(array(pmod(pmod(xxhash64({key}, r), {n}) - x, {n})),
                  y -> if(xxhash64({key}, r, greatest(x, y), 'swap') % 2 = 0, x, y))[0])""")


def mixed_slots(counts: DataFrame, quotas: DataFrame, seed: int) -> DataFrame:
    """(shard, slot, source_no, pass, block): which block each slot of the output holds."""
    before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    in_shard = Window.partitionBy("shard").orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    j = (counts.withColumn("_j", F.coalesce(F.sum("n").over(before), F.lit(0)))
         .withColumn("_slot", F.coalesce(F.sum("n").over(in_shard), F.lit(0)))
         .join(quotas.select("source_no", "n_blocks"), "source_no")
         # few rows make all slots: a width of their own, or one task would
         .repartition(tasks(counts.sparkSession), "shard", "source_no")
         .withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
         .withColumn("_j", F.col("_j") + F.col("_i")))
    return (j.withColumn("pass", F.floor(F.col("_j") / F.col("n_blocks")))
            .withColumn("_p", F.col("_j") % F.col("n_blocks"))
            .withColumn("_key", F.xxhash64(F.lit(seed), F.lit("permute"), "source_no", "pass"))
            .select("shard", (F.col("_slot") + F.col("_i")).alias("slot"), "source_no", "pass",
                    _permuted("_p", "n_blocks", "_key").alias("block")))


def mix(docs: DataFrame, seed: int = 17, block_words: int = BLOCK_WORDS, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix as (slots, pieces, documents).

    ``slots``: (shard, slot, source_no, pass, block). ``pieces``: (source_no, block, doc_id, fp, start,
    from_word, n_words), what each block consists of. ``documents``: (doc_id, fp, source, size,
    source_size, target, start). Null text has size 0 and takes no part; a null source is a source of
    its own; rows that repeat a doc_id are documents of their own; an empty table gives empty results.
    Reruns with the same seed agree. Other columns of ``docs`` are not looked at.
    Slots and pieces come from few rows by ``explode``, so Spark takes them for small: a join of them names
    its strategy, or they would be broadcast through the driver.
    """
    rows = written(sized(docs, id_col, text_col, source_col), "mix-sizes")
    sources = written(source_targets(rows), "mix-sources")
    quotas = written(_quotas(sources, block_words), "mix-quotas")
    placed = written(_positions(rows, sources).join(
        sources.select("source_no", "source_size", "target"), "source_no"), "mix-placed")
    b = block_words
    pieces = (placed.filter("size > 0")
              .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / b),
                                                        F.floor((F.col("start") + F.col("size") - 1) / b))))
              .withColumn("from_word", F.greatest(F.lit(0), F.col("block") * b - F.col("start")))
              .withColumn("n_words", F.least(F.col("size"), (F.col("block") + 1) * b - F.col("start")) - F.col("from_word"))
              .select("source_no", "block", "doc_id", "fp", "start", "from_word", "n_words"))
    slots = mixed_slots(written(draw_counts(quotas, seed), "mix-counts"), quotas, seed)
    return slots, pieces, placed


def taken_words(slots: DataFrame, pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken): one row per document."""
    times = slots.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("times"))
    taken = (pieces.hint("merge").join(times, ["source_no", "block"])
             .groupBy("source_no", "start").agg(F.sum(F.col("times") * F.col("n_words")).alias("taken")))
    out = ["doc_id", "size", "source_size", "target"]
    # documents without words share their start with the next one: they stay out of the join
    some = placed.filter("size > 0").hint("merge").join(taken, ["source_no", "start"], "left")
    return (some.select(*out, F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
            .unionByName(placed.filter("size = 0").select(*out, F.lit(0).cast("long").alias("taken"))))


def mixed_documents(docs: DataFrame, seed: int = 17, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as rows of ``docs``: each document once per pass that takes words of it, its text the
    taken stretches (blanks between its words kept), n_chars their length if there is such a column."""
    slots, pieces, placed = mix(docs, seed, block_words)
    runs = (pieces.hint("merge").join(slots.select("source_no", "block", "pass"), ["source_no", "block"])
            .groupBy("source_no", "start", "pass")
            .agg(F.array_sort(F.collect_list(F.struct("from_word", "n_words"))).alias("runs")))
    runs = (placed.filter("size > 0").hint("merge").join(runs, ["source_no", "start"])
            .groupBy("doc_id", "fp", "source", "size").agg(F.collect_list(F.struct("start", "pass", "runs")).alias("passes")))
    runs = runs.withColumnsRenamed({"doc_id": "of_id", "fp": "of_fp", "source": "of_source"})
    rows = packed(docs, id=F.col("doc_id").cast("long"), f=fingerprint(text_or_empty("text")), text=F.col("text"),
                  src=F.col("source").cast("string"))
    j = rows.join(runs.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("of_id")) & (F.col("f") == F.col("of_fp"))
                  & F.col("src").eqNullSafe(F.col("of_source")))
    # rows alike in id, text and source share one list: number them and let each take its own start
    j = j.withColumn("starts", F.array_sort(F.array_distinct(F.transform("passes", lambda p: p["start"]))))
    same = Window.partitionBy("of_id", "of_fp", "of_source").orderBy(F.lit(1))
    one = j.filter(F.size("starts") == 1).withColumn("start", F.element_at("starts", 1))
    more = (j.filter(F.size("starts") > 1).withColumn("k", F.row_number().over(same))
            .withColumn("start", F.element_at("starts", F.col("k"))).drop("k"))
    j = one.unionByName(more).withColumn("taken", F.explode(F.expr("filter(passes, p -> p.start = start)")))
    whole = F.expr("aggregate(taken.runs, 0L, (n, r) -> n + r.n_words) = size")
    cut = F.expr(f"""transform(array(regexp_extract_all(text, r'{WORD_WITH_BLANKS}', 0)), w ->
        array_join(transform(taken.runs, r ->
            array_join(slice(w, cast(r.from_word as int) + 1, cast(r.n_words as int)), '')), ''))[0]""")
    j = j.withColumn("text", F.when(whole, F.col("text")).otherwise(cut))
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return j.select(row.alias("row")).select("row.*")
