from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.entities import ENTITIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.streaming.feed import stage_table_schema  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        # tiny inputs: compiling a stage takes longer than interpreting it
        spark__sql__codegen__wholeStage="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DEFAULTS = {
    "created_date": "2024-01-05 08:00:00",
    "modified_date": "2024-01-06 08:00:00",
}


@pytest.fixture(scope="session")
def stage_frame(spark):
    """Stage rows of an entity from dictionaries; what a row leaves out is a default or NULL."""
    from datetime import datetime

    def build(entity: str, rows: list[dict], file: str = "a.csv", copied: str = "2024-03-01 00:00:00"):
        schema = stage_table_schema(ENTITIES[entity])
        full = []
        for row in rows:
            values = DEFAULTS | {
                "_stg_file_name": file,
                "_stg_load_ts": datetime.fromisoformat(copied),
                "_copy_ts": datetime.fromisoformat(copied),
            }
            values |= row
            full.append(tuple(values.get(name) for name in schema.fieldNames()))
        return spark.createDataFrame(full, schema)

    return build
