"""Model operators: assemble, fit, score, evaluate, gate, save, load.

ML1-ML6, ML12, SNK12, SRC6. MLlib's gradient-boosted trees replace the
original's leaf-wise booster (no MLlib equivalent of 31 leaves), so
acceptance is the quality gate and the seasonal-naive comparison, not
equal numbers. Training data is the feature grid (zones x hours), small
next to the order volume; it is cached once for the many per-tree jobs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.config import FEATURE_COLUMNS, Config
from zonecast.functions import columns as colf
from zonecast.operators import metrics as MET


TRAIN_PARTITIONS = 8  # fixed: split candidates must not depend on the cluster


class TrainingSkipped(Exception):
    """ML6: not enough rows, or an empty split."""


def assembler(cols=FEATURE_COLUMNS) -> VectorAssembler:
    """ML1: the 16 inputs, in order, as one vector (booleans become 0/1)."""
    return VectorAssembler(inputCols=list(cols), outputCol="features_vec", handleInvalid="keep")


def gbt_pipeline(cfg: Config, max_iter: int | None = None) -> Pipeline:
    """ML2: boosted regression trees with the fixed hyper-parameters."""
    gbt = GBTRegressor(featuresCol="features_vec", labelCol="label",
                       maxIter=max_iter or cfg.max_iter, stepSize=cfg.step_size,
                       maxDepth=cfg.max_depth, seed=cfg.seed)
    return Pipeline(stages=[assembler(), gbt])


def _prepare(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.col("order_count").cast("double"))


def train(features: DataFrame, cfg: Config, max_iter: int | None = None,
          min_rows: int | None = None) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """FLT1, FLT2, ML6, ML2: split, guard, fit. Returns (model, train, val)."""
    tr, va = MET.split(features, cfg)
    counts = MET.split_counts(features, cfg).first()
    need = cfg.min_train_rows if min_rows is None else min_rows
    if counts["train_rows"] + counts["val_rows"] < need:
        raise TrainingSkipped(f"not enough rows with history: "
                              f"{counts['train_rows'] + counts['val_rows']} < {need}")
    if counts["train_rows"] == 0 or counts["val_rows"] == 0:
        raise TrainingSkipped("training or validation split is empty")
    data = _prepare(tr).repartition(TRAIN_PARTITIONS, "zone_id", "timestamp").cache()
    try:
        model = gbt_pipeline(cfg, max_iter).fit(data)
    finally:
        data.unpersist()
    return model, tr, va


def gbt_scorer(model: PipelineModel):
    """ML3 as a scorer for the forecast: adds ``prediction``."""
    def score(df: DataFrame) -> DataFrame:
        return model.transform(df).drop("features_vec")
    return score


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """ML3: predictions clipped at 0 (FN15)."""
    out = model.transform(_prepare(df))
    return out.withColumn("prediction", colf.clip_at_zero("prediction")).drop("features_vec", "label")


def evaluate_model(model: PipelineModel, val: DataFrame) -> DataFrame:
    """ML4 + AG10 + AG11 + ML5: one row with model and baseline metrics."""
    out = MET.evaluate(score(model, val), baseline="lag_168h")
    return out.withColumn("promoted", F.col("mape") < F.col("baseline_mape"))


def promote(mape: float, baseline_mape: float | None) -> bool:
    """ML5: strictly better than the baseline (equal is not promoted, T29)."""
    return baseline_mape is not None and mape < baseline_mape


def save_model(model: PipelineModel, model_dir: str, as_of: dt.datetime) -> str:
    """SNK12: always saved under a time-stamped name."""
    path = f"{model_dir.rstrip('/')}/model_{as_of:%Y%m%d_%H%M%S}"
    model.write().overwrite().save(path)
    return path


def load_latest_model(store, model_dir: str) -> tuple[PipelineModel, str]:
    """SRC6: pointer, else the lexicographically last artefact, else error."""
    path = store.model_pointer()
    if path is None:
        names = [n for n in store.list_dirs(model_dir) if n.startswith("model_")]
        if not names:
            raise FileNotFoundError(f"no model under {model_dir}")
        path = f"{model_dir.rstrip('/')}/{names[-1]}"
    return PipelineModel.load(path), path
