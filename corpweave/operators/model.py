"""The revenue regression on golden features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave import schemas
from corpweave.operators.features import CATEGORY, LABEL, NUMERIC, complete, is_complete

SPLIT_KEY = ("corporate_id", "tech_record_id", "reg_record_id")
TRAIN_PERCENT = 80
SEED = 42


def industry_encoding() -> Pipeline:
    """Industry text to index (frequent first) to one-hot vector; unseen text is all zero."""
    return Pipeline(stages=[
        StringIndexer(inputCol=CATEGORY, outputCol="industry_idx", handleInvalid="keep"),
        OneHotEncoder(inputCols=["industry_idx"], outputCols=["industry_ohe"], dropLast=True),
    ])


def revenue_pipeline() -> Pipeline:
    # The regression's parameters.
    regression = LinearRegression(
        featuresCol="features", labelCol=LABEL, maxIter=200, regParam=0.1, elasticNetParam=0.5
    )
    inputs = VectorAssembler(inputCols=[*NUMERIC, "industry_ohe"], outputCol="features")
    return Pipeline(stages=[*industry_encoding().getStages(), inputs, regression])


def split(df: DataFrame, stable: bool = True, key: tuple[str, ...] = SPLIT_KEY,
          seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, about 80 to 20.

    The stable split hashes the row key, so it does not depend on how rows are partitioned and a
    row stays on its side from run to run. Otherwise Spark's ``randomSplit``.
    """
    if not stable:
        train, test = df.randomSplit([TRAIN_PERCENT / 100, 1 - TRAIN_PERCENT / 100], seed=seed)
        return train, test
    draw = split_draw(key, seed)
    return df.where(draw < TRAIN_PERCENT), df.where(draw >= TRAIN_PERCENT)


def split_draw(key: tuple[str, ...] = SPLIT_KEY, seed: int = SEED):
    """A number from 0 to 99 that depends on the row key only."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]
    digest = F.sha2(F.concat_ws("|", F.lit(str(seed)), *cells), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    mae: float
    train_rows: int
    test_rows: int

    def report(self, spark) -> DataFrame:
        row = ("LinearRegression", self.train_rows, self.test_rows, (self.mae,))
        return spark.createDataFrame([row], schemas.RUN_REPORT)


def split_counts() -> list[Column]:
    """``train_rows`` and ``test_rows`` of the stable split, to be observed while features are written."""
    draw = split_draw()
    return [F.count_if(is_complete() & (draw < TRAIN_PERCENT)).alias("train_rows"),
            F.count_if(is_complete() & (draw >= TRAIN_PERCENT)).alias("test_rows")]


def train(features: DataFrame, pipeline: Pipeline | None = None, stable: bool = True,
          counts: dict[str, int] | None = None) -> Trained:
    """Fit on the train rows and take the mean absolute error on the test rows.

    ``features`` should be a stored frame: fitting reads it several times. With ``counts``, observed
    when it was stored, the rows of both sides are not counted again.
    """
    needed = dict.fromkeys([*SPLIT_KEY, CATEGORY, *NUMERIC, LABEL])
    rows = complete(features.select(*[c for c in needed if c in features.columns]))
    train_rows, test_rows = split(rows, stable)
    model = (pipeline or revenue_pipeline()).fit(train_rows)
    predicted = model.transform(test_rows)
    mae = RegressionEvaluator(
        labelCol=LABEL, predictionCol="prediction", metricName="mae"
    ).evaluate(predicted)
    if counts is None:
        counts = {"train_rows": train_rows.count(), "test_rows": test_rows.count()}
    return Trained(model, mae, counts["train_rows"], counts["test_rows"])
