"""Stage 4: features, model and report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Observation, SparkSession

from corpweave.operators import features, model
from corpweave.sources import files, registry_table


def run(spark: SparkSession, golden_corporate_registry: str, output_dataset_path: str,
        model_output_path: str, model_report_path: str, as_of: date | None = None,
        run_date: str | None = None, stable_split: bool = True) -> model.Trained:
    """The source may be a catalog table, a parquet folder or a folder of buckets.

    Features are stored first, with incomplete rows, and the model is fitted on the stored copy. The
    report's row counts are observed during that write.
    """
    day = run_date or files.run_date()
    golden = None
    if "/" in golden_corporate_registry:
        golden = registry_table.current(spark, golden_corporate_registry)
    if golden is None:
        golden = files.read(spark, golden_corporate_registry)
    dataset = files.dated(output_dataset_path, day)
    rows, counts = features.with_features(golden, as_of), None
    if stable_split:  # a random split is not known before it is made
        counts = Observation("split")
        rows = rows.observe(counts, *model.split_counts())
    files.write(rows, dataset)
    trained = model.train(spark.read.parquet(dataset), stable=stable_split, counts=counts and counts.get)
    trained.model.write().overwrite().save(files.dated(model_output_path, day))
    files.write_report(trained.report(spark), model_report_path, day)
    return trained
