"""JSON documents: nested types, unknown fields, faults with their reason."""

import pytest
from pyspark.sql import types as T

from tidemark.sources.nested import RAW, REASON, RESCUED, read_documents

LINES = {
    '{"id": 1, "user": {"id": 2, "name": "é"}, "tags": ["a", "b"], "marks": {"x": 1}}': None,
    '{"id": 2}': None,
    '{"id": 3, "user": null, "tags": [], "marks": {}, "new": {"deep": [1, 2]}, "more": "t"}': None,
    '{"id": 4, "tags": [null, "a"], "marks": {"x": null}, "user": {"id": null}}': None,
    '{"id": "five"}': "wrong type: id",
    '{"id": 6, "user": {"id": "x", "name": "y"}}': "wrong type: user",
    '{"id": 7, "user": 7, "marks": {"x": "many"}}': "wrong type: user,marks",
    '{"id": 8, "tags": "a"}': "wrong type: tags",
    '{"user": {"id": 9}}': "missing: id",
    '{"id": null}': "missing: id",
    '{"id": 10, "tags": ["a"': "no JSON object",
    "[1, 2]": "no JSON object",
    "plain": "no JSON object",
}


@pytest.fixture(scope="module")
def read(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("documents") / "one.json"
    path.write_text("\n".join([*LINES, "", "  "]) + "\n")
    user = T.StructType().add("id", "long").add("name", "string")
    schema = T.StructType().add("id", "long").add("user", user)
    schema = schema.add("tags", T.ArrayType(T.StringType())).add("marks", T.MapType(T.StringType(), T.IntegerType()))
    return read_documents(spark, str(path), schema, required=("id",))


def test_faults_are_set_apart_with_their_reason(read):
    got = {r[RAW]: r[REASON] for r in read[1].collect()}
    assert got == {k: v for k, v in LINES.items() if v}


def test_documents_are_typed_and_unknown_fields_kept(read):
    rows = {r.id: r for r in read[0].collect()}
    assert sorted(rows) == [1, 2, 3, 4]
    assert (rows[1].user.id, rows[1].user.name, rows[1].tags, rows[1].marks) == (2, "é", ["a", "b"], {"x": 1})
    assert (rows[2].user, rows[2].tags, rows[2].marks, rows[2][RESCUED]) == (None, None, None, None)
    assert rows[3][RESCUED] == {"new": '{"deep":[1,2]}', "more": "t"}
    assert (rows[4].tags, rows[4].marks, rows[4].user.id) == ([None, "a"], {"x": None}, None)
