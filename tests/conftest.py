import pytest

from weftline.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    root = tmp_path_factory.mktemp("spark")
    SparkSession.builder.config("spark.sql.warehouse.dir", str(root / "warehouse")).config("spark.checkpoint.dir", str(root / "shared"))
    s = local_session(cores=8, partitions=8, memory="6g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
