"""Where intermediate tables go."""

import pytest

from strata.session import materialize, run_together, shared_folder


class _Session:
    """The two settings that choose the folder."""

    def __init__(self, master, folder):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}


def test_the_folder_that_the_cluster_names():
    assert shared_folder(_Session("spark://host:7077", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_folder(_Session("local[2]", "/named")) == "/named"


def test_only_a_local_session_may_use_this_machine():
    local = shared_folder(_Session("local[2]", None))
    assert local == shared_folder(_Session("local[*]", None))
    with pytest.raises(RuntimeError):
        shared_folder(_Session("yarn", None))


def test_materialized_rows_and_schema(spark):
    df = spark.range(5).selectExpr("id", "struct(id AS a) AS s", "CAST(NULL AS DATE) AS d")
    stored = materialize(df, "test")
    assert stored.schema.simpleString() == df.schema.simpleString()
    assert sorted(stored.collect()) == sorted(df.collect())


def test_a_failed_write_is_raised():
    def fail():
        raise ValueError("disk")

    done = []
    with pytest.raises(ValueError, match="disk"):
        run_together([lambda: done.append(1), fail, lambda: done.append(2)])
    assert sorted(done) == [1, 2]
