import pytest

from tidemark.entities import ENTITIES
from tidemark.operators.clean import clean_rows
from tidemark.sources.text_csv import MALFORMED, read_extract


def write(path, text):
    path.mkdir()
    (path / "part.csv").write_text(text, encoding="utf-8")
    return str(path)


def test_extract_text_rules(spark, tmp_path):
    folder = write(
        tmp_path / "location",
        "location_id,city,state,zipcode,active_flag,created_date,modified_date\n"
        '1,"Elm, upper part",Hillside,00420,Y,2021-02-03 04:05:06,2021-07-08 09:10:11\n'
        '2,"the ""old"" mill",NULL,,"",2022-03-04 05:06:07,NULL\n'
        "3,Mühlbach,Lowland,00001,N,x,y\n",
    )
    rows = {r.location_id: r for r in read_extract(spark, folder, ENTITIES["location"]).collect()}
    assert rows["1"].city == "Elm, upper part"
    assert rows["1"].zipcode == "00420"
    assert rows["2"].city == 'the "old" mill'
    assert rows["2"].state is None and rows["2"].zipcode is None and rows["2"].active_flag is None
    assert rows["2"].modified_date is None
    assert rows["3"].city == "Mühlbach"
    assert rows["1"]._stg_file_name == "part.csv"
    assert rows["1"]._stg_load_ts is not None and rows["1"]._copy_ts is not None


def test_wrong_number_of_fields_is_landed_as_malformed(spark, tmp_path):
    folder = write(
        tmp_path / "location",
        "location_id,city,state,zipcode,active_flag,created_date,modified_date\n"
        "1,Elm,Hillside,00420,Y,a,b\n2,Ash,Lowland,1,Y,a,b,surplus,more\n3,Oak\n",
    )
    stage = read_extract(spark, folder, ENTITIES["location"])
    marks = {r.location_id: r[MALFORMED] for r in stage.collect()}
    assert marks == {"1": None, "2": "2,Ash,Lowland,1,Y,a,b,surplus,more", "3": "3,Oak"}
    accepted, rejected = clean_rows(stage, ENTITIES["location"])
    assert [r.location_id for r in accepted.collect()] == [1]
    assert {r.reject_reason for r in rejected.collect()} == {"malformed line"}


def test_a_reordered_header_fails_the_file(spark, tmp_path):
    folder = write(
        tmp_path / "location", "city,location_id,state,zipcode,active_flag,created_date,modified_date\nElm,1,H,0,Y,a,b\n"
    )
    with pytest.raises(Exception, match="(?i)header"):
        read_extract(spark, folder, ENTITIES["location"]).collect()


def test_header_only_extract_is_empty(spark, tmp_path):
    folder = write(tmp_path / "orders", ",".join(ENTITIES["orders"].stage_schema().fieldNames()) + "\n")
    assert read_extract(spark, folder, ENTITIES["orders"]).count() == 0


def test_every_stage_column_is_text(spark):
    for entity in ENTITIES.values():
        assert {f.dataType.simpleString() for f in entity.stage_schema().fields} == {"string"}


def test_lines_are_written_as_they_are_in_many_files_with_a_header_each(spark, tmp_path):
    from tidemark.registry.queries import write_lines

    lines = [f'{i}, "a ""b"" \\,x ,NULL,' for i in range(40)]
    frame = spark.createDataFrame([(line,) for line in lines], "value string").repartition(4)
    write_lines(frame, "id,name,other", f"{tmp_path}/lines")
    files = [f.read_text().splitlines() for f in (tmp_path / "lines").glob("part-*")]
    files = [f for f in files if f]
    assert len(files) == 4 and all(f[0] == "id,name,other" for f in files)
    assert sorted(line for f in files for line in f[1:]) == sorted(lines)
