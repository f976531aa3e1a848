"""Learned forecasters on Spark ML.

R14: a gradient-boosted regressor on a tabular window (lags of the target, calendar,
time to delivery and the contract index), one model for all contracts.
R15: a ridge regression stacking the point forecasts of the simple forecasters.
Both train on the training split and predict the validation split; training is
distributed by Spark ML.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lag_features(df: DataFrame, target: str = "close", lags: int = 24, horizon: int = 1) -> DataFrame:
    """Tabular window: ``lag_1..lag_n`` of the target, the label ``target`` ``horizon`` rows ahead
    and the mask of that row."""
    w = Window.partitionBy("asset").orderBy("ts")
    cols = {f"lag_{i}": F.lag(target, i - 1).over(w) for i in range(1, lags + 1)}
    cols["label"] = F.lead(target, horizon).over(w)
    cols["label_mask"] = F.lead(F.col("is_trading").cast("double"), horizon).over(w)
    cols["label_ts"] = F.lead("ts", horizon).over(w)
    return df.withColumns(cols).dropna(subset=[f"lag_{lags}", "label"])


def gbt_forecast(train: DataFrame, val: DataFrame, target: str = "close", lags: int = 24,
                 horizon: int = 1, max_iter: int = 20, max_depth: int = 4, seed: int = 7) -> DataFrame:
    """GBT on lags + calendar + time to delivery + contract (StringIndexer); returns
    (asset, ts, label, label_mask, prediction) for validation rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    extra = [c for c in ("hour_of_day", "day_of_week", "time_to_delivery") if c in train.columns]
    feats = [f"lag_{i}" for i in range(1, lags + 1)] + extra + ["asset_ix"]
    pipe = Pipeline(stages=[
        StringIndexer(inputCol="asset", outputCol="asset_ix", handleInvalid="keep"),
        VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep"),
        GBTRegressor(featuresCol="features", labelCol="label", maxIter=max_iter, maxDepth=max_depth, seed=seed)])
    tr = lag_features(train, target, lags, horizon).filter(F.col("label_mask") == 1)  # labels that count
    model = pipe.fit(tr)
    va = lag_features(val, target, lags, horizon)
    return model.transform(va).select("asset", "ts", "label_ts", "label", "label_mask", "prediction")


def ridge_stack(train_preds: DataFrame, val_preds: DataFrame, inputs: Sequence[str],
                reg_param: float = 1.0) -> DataFrame:
    """Ridge (L2, elasticNetParam=0) over the base forecasts ``inputs`` -> ``prediction``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(inputs), outputCol="features", handleInvalid="skip"),
        LinearRegression(featuresCol="features", labelCol="y", regParam=reg_param, elasticNetParam=0.0)])
    model = pipe.fit(train_preds)
    return model.transform(val_preds).drop("features")
