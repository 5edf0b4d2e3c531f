"""Tables that are replaced whole: commits, lost writers, two writers, thinning."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.functions.schemas import LONG, record
from strata.session import run_together
from strata.sources import folders, gold, metadata, versions

SCHEMA = record(n=LONG)


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], SCHEMA)


def saver(df):
    return df.write.parquet


def rows(spark, root):
    return sorted(r.n for r in versions.read(spark, root, SCHEMA)[0].collect())


def test_versions_follow_each_other(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.latest(spark, root) == versions.NONE and rows(spark, root) == []
    versions.write(spark, root, 2, saver(numbers(spark, 1)))
    versions.write(spark, root, 3, saver(numbers(spark, 1, 2)))
    assert versions.versions(spark, root) == [2, 3] and rows(spark, root) == [1, 2]


def test_of_two_writers_one_has_to_start_again(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.write(spark, root, 2, saver(numbers(spark, 1)))

    def late(folder):
        numbers(spark, 7).write.parquet(folder)
        versions.write(spark, root, 3, saver(numbers(spark, 1, 5)))  # the other one is faster

    with pytest.raises(versions.VersionTaken):
        versions.write(spark, root, 3, late)
    assert rows(spark, root) == [1, 5]
    assert len(os.listdir(f"{root}/data")) == 2  # the loser's files are gone
    with pytest.raises(versions.VersionTaken):
        versions.write(spark, root, 3, saver(numbers(spark, 9)))


def test_updates_from_many_writers_are_all_kept(spark, tmp_path):
    root = str(tmp_path / "t")

    def add(value):
        versions.update(spark, root, SCHEMA, lambda old: old.unionByName(numbers(spark, value)))

    run_together([lambda v=v: add(v) for v in range(6)], at_once=3)
    assert rows(spark, root) == list(range(6))
    before = versions.latest(spark, root)
    assert versions.update(spark, root, SCHEMA, lambda old: None) == before


def test_thinning_keeps_the_newest(spark, tmp_path):
    root = str(tmp_path / "t")
    for version in range(2, 10):
        versions.write(spark, root, version, saver(numbers(spark, version)), keep=3)
    assert versions.versions(spark, root) == [7, 8, 9] and rows(spark, root) == [9]
    assert len(os.listdir(f"{root}/data")) == 3


def test_text_files_are_created_once(spark, tmp_path):
    path = str(tmp_path / "a" / "b")
    assert folders.create_text(spark, path, "first")
    assert not folders.create_text(spark, path, "second")
    assert folders.read_text(spark, path) == "first"
    assert folders.names(spark, str(tmp_path / "a")) == ["b"]
    assert folders.names(spark, str(tmp_path / "nowhere")) == []


@pytest.mark.parametrize("fmt", gold.FORMATS)
def test_a_failing_write_keeps_the_old_mart(spark, tmp_path, fmt):
    path = str(tmp_path / "mart")
    with pytest.raises(FileNotFoundError):
        gold.read_mart(spark, path, fmt, SCHEMA)
    gold.write_mart(numbers(spark, 1, 2), path, fmt)
    broken = spark.range(4).select(F.raise_error(F.lit("lost")).cast("long").alias("n"))
    with pytest.raises(Exception, match="lost"):
        gold.write_mart(broken, path, fmt)
    assert sorted(r.n for r in gold.read_mart(spark, path, fmt, SCHEMA).collect()) == [1, 2]
    gold.write_mart(numbers(spark, 3), path, fmt)
    assert [r.n for r in gold.read_mart(spark, path, fmt, SCHEMA).collect()] == [3]


def test_a_year_of_runs_is_one_file(spark, tmp_path):
    def daily(day):
        return spark.createDataFrame(
            [(day, True, 2, 0.5, ["a"])],
            "dt date, drift_detected boolean, total_new_variants long, max_failure_rate double, "
            "affected_tracks array<string>",
        )

    days = [dt.date(2024, 1, 1) + dt.timedelta(days=40 * n) for n in range(9)]
    for day in days:
        metadata.append_history(daily(day), str(tmp_path))
    history = metadata.read_history(spark, str(tmp_path))
    assert sorted(r.dt for r in history.collect()) == days
    assert len(history.inputFiles()) == 1
    assert len(os.listdir(tmp_path / "drift_history" / "data")) == versions.KEPT


def test_two_runs_register_their_variants_both(spark, tmp_path):
    root, now = str(tmp_path), dt.datetime(2024, 1, 1)

    def registry(*variants):
        rows = [("t", v, dt.date(2024, 1, 1), now) for v in variants]
        return spark.createDataFrame(rows, metadata.REGISTRY)

    metadata.write_registry(registry("a"), root, 2)

    def merge(known):
        if metadata.registry_version(spark, root) == 2:  # another run commits meanwhile
            metadata.write_registry(registry("a", "b"), root, 3)
        return known.unionByName(registry("c")).dropDuplicates(["track", "payload_variant"])

    assert metadata.update_registry(spark, root, merge) == 4
    known, version = metadata.read_registry(spark, root)
    assert version == 4 and sorted(r.payload_variant for r in known.collect()) == ["a", "b", "c"]
    assert metadata.update_registry(spark, root, lambda known: known) == 4
    with pytest.raises(versions.VersionTaken):
        metadata.write_registry(registry("z"), root, 4)
