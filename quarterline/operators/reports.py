"""Experiment reports (A17-A19, K4, K6, W10, R16): small result tables, all in Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import loss_for_ranking


def best_strategy(results: DataFrame) -> DataFrame:
    """Arg-min validation loss among successful strategies (non-finite loss ranks last)."""
    ok = results.filter(F.col("success")).withColumn("_loss", loss_for_ranking("val_loss"))
    return ok.agg(F.min_by("strategy", F.struct("_loss", "strategy")).alias("best_strategy"),
                  F.min("_loss").alias("best_val_loss"),
                  F.count(F.lit(1)).alias("n_successful"))


def study_stats(trials: DataFrame) -> DataFrame:
    """Trials by state, best value / trial / parameters, mean and total duration per study."""
    complete = F.col("state") == "COMPLETE"
    loss = F.when(complete, loss_for_ranking("value"))
    # the ordering key is NULL (ignored) for trials that did not complete
    best = F.min_by(F.struct("trial", "lr", "batch_size", "max_context_length"),
                    F.when(complete, F.struct(loss.alias("l"), F.col("trial").alias("t"))))
    return trials.groupBy("study").agg(
        F.count(F.lit(1)).alias("n_trials"),
        F.count_if(complete).alias("n_complete"),
        F.count_if(F.col("state") == "PRUNED").alias("n_pruned"),
        F.count_if(F.col("state") == "FAIL").alias("n_failed"),
        F.min(loss).alias("best_value"),
        best.alias("best"),
        F.avg("duration_s").alias("mean_duration_s"),
        F.sum("duration_s").alias("total_duration_s")).select(
        "study", "n_trials", "n_complete", "n_pruned", "n_failed", "best_value",
        F.col("best.trial").alias("best_trial"), F.col("best.lr").alias("best_lr"),
        F.col("best.batch_size").alias("best_batch_size"),
        F.col("best.max_context_length").alias("best_max_context_length"),
        "mean_duration_s", "total_duration_s")


def top_trials(trials: DataFrame, k: int = 5, min_complete: int = 5) -> DataFrame:
    """K4: the k best completed trials per study, only for studies with >= ``min_complete`` completed."""
    c = trials.filter(F.col("state") == "COMPLETE").withColumn("_loss", loss_for_ranking("value"))
    w = Window.partitionBy("study")
    c = (c.withColumn("_n", F.count(F.lit(1)).over(w))
          .withColumn("rank", F.row_number().over(w.orderBy("_loss", "trial"))))
    return c.filter((F.col("_n") >= min_complete) & (F.col("rank") <= k)).drop("_n", "_loss")


def best_trial(trials: DataFrame) -> DataFrame:
    """K6: best completed trial per study; ties on the loss go to the largest learning rate,
    then the smallest context length."""
    c = trials.filter(F.col("state") == "COMPLETE").withColumn("_loss", loss_for_ranking("value"))
    w = Window.partitionBy("study").orderBy("_loss", F.desc_nulls_last("lr"),
                                            F.asc_nulls_last("max_context_length"), "trial")
    return c.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "_loss")


def epoch_history(batch_losses: DataFrame) -> DataFrame:
    """Mean train / val loss per (stage, epoch) from per-batch loss rows."""
    return (batch_losses.groupBy("stage", "epoch")
            .agg(F.avg(F.when(F.col("phase") == "train", F.col("loss"))).alias("train_loss"),
                 F.avg(F.when(F.col("phase") == "val", F.col("loss"))).alias("val_loss")))


def stage_boundaries(history: DataFrame, stage_order: Sequence[str]) -> DataFrame:
    """Global epoch index over the stages in order, and the first row of each stage."""
    order = F.array_position(F.array(*[F.lit(s) for s in stage_order]), F.col("stage"))
    h = history.withColumn("_so", order)
    g = h.withColumn("global_epoch", F.row_number().over(Window.orderBy("_so", "epoch")))
    first = F.row_number().over(Window.partitionBy("stage").orderBy("epoch")) == 1
    return g.withColumn("stage_start", first).drop("_so")


def strategy_results(scores: DataFrame, converge_epochs: int = 20) -> DataFrame:
    """A8-shaped strategy table from per-strategy scores: (strategy, val_loss, n_windows) ->
    success when the strategy produced windows."""
    return scores.select(
        "strategy", F.lit(None).cast("double").alias("training_time_minutes"),
        F.lit(None).cast("int").alias("epochs_trained"), F.col("val_loss").cast("double").alias("val_loss"),
        F.lit(None).cast("boolean").alias("converged"), (F.col("n_windows") > 0).alias("success"))
