from __future__ import annotations

import pytest


@pytest.fixture
def documents(spark):
    def make(rows, extra=()):
        names = ["doc_id", "text", *extra]
        kinds = ", ".join(f"`{n}` {'long' if n == 'doc_id' else 'string'}" for n in names)
        return spark.createDataFrame(rows, kinds)

    return make
