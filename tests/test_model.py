from datetime import date

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array

from corpweave.operators import features, model
from tests.conftest import rows

GOLDEN = ("corporate_id string, tech_record_id string, reg_record_id string, "
          "tech_industry_std string, reg_industry_std string, tech_estimated_revenue double, "
          "reg_year_founded double, reg_total_employee_estimate bigint")


def one(spark, tech=None, reg=None, revenue=1.0, year=2000.0, staff=1):
    return spark.createDataFrame([("c", "t", "r", tech, reg, revenue, year, staff)], GOLDEN)


@pytest.mark.parametrize("tech, reg, wanted", [
    ("semiconductors", "retail", "semiconductors"), ("N/A", "retail", "retail"),
    (None, "N/A", None), ("n/a", "retail", "n/a"), (None, "retail", "retail"), ("N/A", "N/A", None),
])
def test_industry(spark, tech, reg, wanted):
    got = features.with_features(one(spark, tech, reg), date(2026, 1, 1)).first()
    assert got.industry_std == wanted


@pytest.mark.parametrize("year, age, log", [
    (2000.0, 26.0, 3.295836866004329), (None, None, None), (2027.0, -1.0, None),
    (2030.0, -4.0, None),
])
def test_age(spark, year, age, log):
    got = features.with_features(one(spark, year=year), date(2026, 6, 1)).first()
    assert got.company_age == age
    assert got.log_company_age == (pytest.approx(log) if log else None)


def test_complete(spark):
    some = one(spark, "x").unionByName(one(spark)).unionByName(one(spark, "x", year=2027.0))
    some = some.unionByName(one(spark, "x", staff=None)).unionByName(
        one(spark, "x", revenue=float("nan"))
    )
    assert features.complete(features.with_features(some, date(2026, 1, 1))).count() == 1


@pytest.fixture(scope="module")
def training_rows(spark):
    golden = spark.range(600).selectExpr(
        "string(id) corporate_id", "string(id) tech_record_id", "string(id % 7) reg_record_id",
        "element_at(array('a', 'b', 'c'), int(id % 3) + 1) tech_industry_std",
        "'N/A' reg_industry_std", "exp(2 + (id % 3) + log1p(id % 50) * 0.5D) tech_estimated_revenue",
        "double(1980 + id % 40) reg_year_founded", "id % 50 reg_total_employee_estimate",
    )
    return features.with_features(golden, date(2026, 1, 1)).cache()


def test_stable_split(training_rows):
    train, test = model.split(training_rows)
    again, _ = model.split(training_rows.repartition(7))
    assert rows(train.select("corporate_id")) == rows(again.select("corporate_id"))
    assert train.count() + test.count() == 600 and 420 < train.count() < 540
    train, test = model.split(training_rows, stable=False)
    assert train.count() + test.count() == 600


def test_encoding(spark, training_rows):
    fitted = model.industry_encoding().fit(training_rows)
    slots = vector_to_array("industry_ohe")
    seen = fitted.transform(spark.createDataFrame([("a",), ("new",)], "industry_std string"))
    assert [list(r[0]) for r in seen.select(slots).collect()] == [[1.0, 0.0, 0.0], [0.0, 0.0, 0.0]]


def test_training(spark, training_rows, tmp_path):
    trained = model.train(training_rows)
    assert trained.train_rows + trained.test_rows == 600 and 0 < trained.mae < 1
    stages = trained.model.stages
    assert stages[-1].getOrDefault("maxIter") == 200
    assert stages[-1].getOrDefault("regParam") == 0.1
    assert stages[-1].getOrDefault("elasticNetParam") == 0.5
    _, test = model.split(features.complete(training_rows))
    predicted = trained.model.transform(test)
    by_hand = predicted.selectExpr(f"avg(abs(prediction - {features.LABEL}))").first()[0]
    assert trained.mae == pytest.approx(by_hand)
    trained.model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m")).transform(test)
    assert rows(loaded.select("prediction")) == rows(predicted.select("prediction"))
    report = trained.report(spark).first()
    assert report.model == "LinearRegression" and report.metrics.mae == trained.mae
