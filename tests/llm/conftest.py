import zlib

import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """``docs((doc_id, text, source, ...), ...)``: documents with columns whose names clash with results."""

    def make(*rows, schema="doc_id long, text string, lang string, source string, n_chars long, size string, kept string, row_id string, score string"):
        width = len(schema.split(", "))
        return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)

    return make


@pytest.fixture(scope="session")
def crc():
    return lambda ids: zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))
