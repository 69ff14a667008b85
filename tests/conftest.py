import pytest
from pyspark import cloudpickle

import corpweave
from corpweave.session import local_session


@pytest.fixture(scope="session")
def spark():
    cloudpickle.register_pickle_by_value(corpweave)
    session = local_session(cores=8, partitions=4, memory="8g")
    session.sparkContext.setLogLevel("OFF")
    # Compiling a stage takes longer than running it on a few rows.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    yield session
    session.stop()


@pytest.fixture
def forced_skew(spark):
    """No broadcasts, and adaptive execution splits every partition larger than the others."""
    forced = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in forced}
    for key, value in forced.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
