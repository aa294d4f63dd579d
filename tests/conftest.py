import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from tallyboard.schemas import TABLES, WAREHOUSE  # noqa: E402
from tallyboard.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """``table(name, {...}, {...})``: rows of a known table, unnamed columns NULL."""

    def make(schema: str, *rows: dict):
        ddl = TABLES.get(schema) or WAREHOUSE.get(schema) or schema
        struct = T.StructType.fromDDL(ddl)
        data = [tuple(row.get(f.name) for f in struct.fields) for row in rows]
        return spark.createDataFrame(data, struct)

    return make
