import pytest
from pyspark.sql import SparkSession

from chatmill.deploy import ship


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield ship(session)
    session.stop()


@pytest.fixture
def column(spark):
    """Apply a column function to Python values (tuples for several arguments), in order."""
    from pyspark.sql import functions as F

    def run(fn, values, schema="string"):
        types = [schema] if isinstance(schema, str) else schema
        rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
        names = [f"a{i}" for i in range(len(types))]
        df = spark.createDataFrame(rows, ", ".join(["i int", *[f"{n} {t}" for n, t in zip(names, types, strict=True)]]))
        return [r[1] for r in df.select("i", fn(*[F.col(n) for n in names]).alias("out")).orderBy("i").collect()]

    return run
