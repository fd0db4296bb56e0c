import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[k]) for k in (0, 1)]

from support import AS_OF, make_policy  # noqa: E402

from maskflow import MaskOptions, Salts, deidentify  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "checkpoint"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def salts():
    return Salts({key: f"salt-{key}" for key in ("k", "c", "d", "other", "name", "zip")})


@pytest.fixture
def mask(salts):
    """mask(df, {column: strategies}, **options) -> masked DataFrame."""

    def run(df, columns, **options):
        options.setdefault("as_of_year", AS_OF)
        return deidentify(df, make_policy(columns), salts, MaskOptions(**options))

    return run


@pytest.fixture
def mask_values(spark, mask):
    """Masked values of one column ``c`` given raw ones."""

    def run(values, strategy, dtype="string", **options):
        df = spark.createDataFrame([(v,) for v in values], f"c {dtype}")
        rows = mask(df, {"c": strategy}, **options).collect()
        return [row["c"] for row in rows]

    return run
