"""The fare model: seven numeric features, in bins of equal share, into gradient-boosted trees."""

import math

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow import schemas as S
from fareflow.operators.binning import quantile_bins
from fareflow.session import ensure_checkpoint_dir

# Training parameters of the published model.
MAX_ITER = 50
MAX_DEPTH = 5
SEED = 42
MAX_BINS = 32

# Rows of one training task, unless the cluster has more cores than that makes tasks.
ROWS_PER_TASK = 2_000_000
BINNED = "bin_of_"
# Rounds between lineage cuts, so a lost executor replays a few rounds, not all.
CHECKPOINT_ROUNDS = 10


def fare_trees(max_iter: int = MAX_ITER, max_depth: int = MAX_DEPTH, seed: int = SEED, max_bins: int = MAX_BINS, **params) -> GBTRegressor:
    """Unfitted trees; `params` are further GBTRegressor settings."""
    settings = {"checkpointInterval": CHECKPOINT_ROUNDS, **params}
    return GBTRegressor(
        featuresCol="features",
        labelCol=S.LABEL,
        predictionCol=S.PREDICTION,
        maxIter=max_iter,
        maxDepth=max_depth,
        seed=seed,
        maxBins=max_bins,
        **settings,
    )


def fit_fares(train: DataFrame, partitions: int | None = None, max_bins: int = MAX_BINS, **params) -> PipelineModel:
    """Fits the trees; which splits they may have depends on the rows, not on files, cores or `partitions`.

    One pass finds the bins, another deals the rows evenly, by row and never by key, over
    `partitions` tasks: by default as many as the cluster has cores, or one for every
    ROWS_PER_TASK rows. Sums over rows differ in their last digits with the dealing, which may settle a
    tie between splits that part a node's rows alike.
    """
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    rows = train.select(*S.CLEANED_COLUMNS)
    bins, n = quantile_bins(rows, S.FEATURE_COLUMNS, max_bins, BINNED)
    tasks = partitions or max(spark.sparkContext.defaultParallelism, math.ceil(n / ROWS_PER_TASK))
    assembler = VectorAssembler(inputCols=bins.getOutputCols(), outputCol="features")
    # Without the note that bins are categories: they are ordered, as the features are.
    features = F.col("features").alias("features", metadata={})
    rows = assembler.transform(bins.transform(rows.repartition(tasks))).select(features, S.LABEL)
    return PipelineModel([bins, assembler, fare_trees(max_bins=max_bins, **params).fit(rows)])


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Adds `prediction`; row by row inside the scan's stage."""
    return model.transform(features).drop("features", *[f"{BINNED}{c}" for c in S.FEATURE_COLUMNS])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
