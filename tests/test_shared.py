import pytest

from tidemark.sources import shared


class Stub:
    """As much of a session as the lookup needs."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = {"spark.sql.warehouse.dir": "hdfs://shared/warehouse"} | settings

    def get(self, name, default=None):
        return self.settings.get(name, default)


def test_the_named_folder_is_used():
    named = Stub(**{"spark.checkpoint.dir": "hdfs://shared/x/"})
    assert shared.shared_folder(named) == "hdfs://shared/x"


def test_without_a_name_the_warehouse_is_used():
    assert shared.shared_folder(Stub()) == "hdfs://shared/warehouse/_scratch"


def test_each_scratch_path_is_new(spark):
    assert shared.scratch(spark, "a") != shared.scratch(spark, "a")


def test_first_failure_is_raised_after_all_ran(spark):
    done = []

    def fail():
        raise ValueError("no")

    with pytest.raises(ValueError):
        shared.side_by_side(spark, [fail, lambda: done.append(spark.range(3).count())])
    assert done == [3]


def test_written_frame_reads_back(spark):
    frame = spark.range(4).selectExpr("id", "CAST(id AS decimal(5,0)) AS d")
    again = shared.written(frame, shared.scratch(spark, "t"))
    assert again.dtypes == frame.dtypes and again.count() == 4
