"""The pipeline's stages on the small tables and on awkward rows, and the oracles in SQL."""

import os

import pytest

pipeline = pytest.importorskip("corpus_pipeline")

from llm_tables import SF, awkward, empty  # noqa: E402
from oracle_check import _rows, connect  # noqa: E402
from strata.llm.oracles import llm_oracles  # noqa: E402
from strata.llm.queries import llm_queries  # noqa: E402
from strata.session import materialize  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no benchmark tables")


@pytest.fixture(scope="module")
def con():
    con = connect(SF)
    for name in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", llm_oracles())
def test_query_equals_oracle(spark, con, name):
    df = llm_queries()[name](spark, SF)
    answer = con.execute(llm_oracles()[name])
    names = [column[0] for column in answer.description]
    assert sorted(names) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(names, answer.fetchall())


@pytest.mark.parametrize("name", set(llm_queries()) - set(llm_oracles()))
def test_query_gives_a_row_for_each_input_row(spark, name):
    source = {"op9": "embeddings"}.get(name.split("_")[0], "documents")
    rows = llm_queries()[name](spark, SF)
    key = rows.columns[0]
    wanted = spark.read.parquet(f"{SF}/{source}.parquet").select(key).collect()
    assert sorted(r[0] for r in rows.select(key).collect()) == sorted(r[0] for r in wanted)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        out = materialize(stage(spark, docs, SF), f"test-{name}")
        before, after = (x.select("doc_id") for x in (docs, out))
        assert after.subtract(before).isEmpty() and after.distinct().count() == out.count()
        last = name == pipeline.STAGES[-1][0]
        assert out.count() == docs.count() if last else (
            0 < out.count() <= docs.count() and out.columns == columns
        )
        docs = out
    assert sorted(map(tuple, pipeline.run(spark, SF).collect())) == sorted(
        map(tuple, docs.collect())
    )


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (awkward(spark), empty(spark)):
        for _, stage in pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= docs.count()
            assert out.columns == docs.columns or "ids_crc32" in out.columns
