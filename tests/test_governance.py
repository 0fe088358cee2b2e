from datetime import datetime

import pytest

from tidemark.entities import DIMENSIONS, ENTITIES, dimension_schema
from tidemark.operators.clean import clean_rows, type_rows
from tidemark.operators.governance import TagMissing, masked, tagged_columns
from tidemark.operators.scd2 import scd2
from tidemark.operators.upsert import upsert
from tidemark.sources.tables import empty

CUSTOMER = ENTITIES["customer"]


@pytest.fixture(scope="module")
def customers(stage_frame):
    rows = [{"customer_id": "1", "name": "Ada", "email": "a@x", "dob": "1980-01-01", "gender": "Female"}]
    return type_rows(stage_frame("customer", rows), ENTITIES["customer"])


def test_tags_come_with_the_projection(customers):
    assert tagged_columns(customers) == {"mobile": "PII", "email": "EMAIL", "gender": "PII", "dob": "PII"}


def test_tags_survive_the_clean_step(spark, stage_frame, tmp_path):
    stage = stage_frame("restaurant", [{"restaurant_id": "1", "name": "R", "restaurant_phone": "1"}])
    rows, _ = clean_rows(stage, ENTITIES["restaurant"])
    assert tagged_columns(rows) == {"restaurant_phone": "PII"}
    entity = ENTITIES["delivery_agent"]
    agents = stage_frame("delivery_agent", [{"delivery_agent_id": "1", "name": "A", "phone": "1"}])
    table, _ = upsert(empty(spark, entity.clean_schema()), agents, entity, datetime(2024, 1, 1))
    path = str(tmp_path / "agents")
    table.write.parquet(path)
    stored = spark.read.schema(entity.clean_schema()).parquet(path)
    assert tagged_columns(stored) == {"phone": "PII", "gender": "PII"}


def test_masking(customers):
    row = masked(customers, "ANALYST", CUSTOMER).first()
    assert (row.name, row.email, row.gender, row.dob, row.mobile) == (
        "Ada", "***MASKED***", "***MASKED***", None, None,
    )
    assert masked(customers, "ANALYST", CUSTOMER).schema == customers.schema


def test_privileged_role_sees_everything(customers):
    assert masked(customers, "PII_VIEWER", CUSTOMER).first().email == "a@x"


def test_unknown_tag_is_refused(customers):
    odd = customers.withMetadata("name", {"pii": "SECRET"})
    with pytest.raises(ValueError):
        masked(odd, "ANALYST", CUSTOMER)


@pytest.mark.parametrize("role", ["ANALYST", "PII_VIEWER"])
def test_a_frame_without_its_tags_is_refused(customers, role):
    bare = customers.selectExpr("customer_id", "concat(email, '') AS email")
    with pytest.raises(TagMissing, match="email"):
        masked(bare, role, CUSTOMER)
    # what has no such column needs no tag
    assert masked(customers.select("customer_id", "name"), role, CUSTOMER).count() == 1


def test_every_tag_survives_upsert_dimension_and_rejects(spark, stage_frame):
    stamp = datetime(2024, 1, 1)
    for name in ("customer", "restaurant", "delivery_agent"):
        entity = ENTITIES[name]
        stage = stage_frame(name, [{entity.key: "1", "name": "N"}, {entity.key: "x", "name": "N"}])
        first, rejects = upsert(empty(spark, entity.clean_schema()), stage, entity, stamp)
        second, _ = upsert(first, stage, entity, stamp)
        for frame in (first, second, rejects):
            assert tagged_columns(frame) == entity.tags
        dim = DIMENSIONS[f"{name}_dim"]
        versions = scd2(empty(spark, dimension_schema(dim)), second, dim, stamp)
        assert tagged_columns(versions) == dim.tags
        assert tagged_columns(scd2(versions, second, dim, stamp)) == dim.tags
        assert masked(versions, "ANALYST", dim).count() == 1
    assert DIMENSIONS["customer_dim"].tags == {"mobile": "PII", "email": "EMAIL", "gender": "PII", "dob": "PII"}
