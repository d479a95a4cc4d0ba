"""The registered queries: SQL where there is one, and the pipeline's stages."""

import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
import corpus_pipeline
from tallywatch.llm import queries
from tallywatch.llm.tables import clear, stored

from .conftest import SF
from .test_jaccard_join import plain as plain_groups


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for file in os.listdir(SF):
        database.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    expected = database.execute(queries.oracle_sql()[name])
    columns = [column[0] for column in expected.description]
    rows = spark_entry.queries()[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, rows)) == sorted(expected.fetchall())


def test_one_query_per_operator():
    names = spark_entry.queries()
    for number in range(1, 14):
        assert len([name for name in names if name.startswith(f"op{number}_")]) == 1
    assert "pipeline" in names


def test_pipeline_stages(spark, docs, table):
    """Each stage keeps what a plain filter over the scores of its input keeps."""
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    at, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = table(stage(spark, at, SF))
        assert after.columns == documents.columns
        kept[name] = (at, after)
        at = after
    for name, score_of, wanted in (
        ("quality", queries.quality_scores, 1),
        ("toxicity", queries.toxicity_scores, 0),
    ):
        before, after = kept[name]
        scores = score_of(before, spark.read.parquet(f"{SF}/labels.parquet")).collect()
        expected = sorted(row.doc_id for row in scores if row.predicted == wanted)
        assert sorted(row.doc_id for row in after.collect()) == expected
    before, after = kept["near_duplicates"]
    groups = plain_groups([(row.doc_id, row.text) for row in before.collect()])
    left = {row.doc_id for row in after.collect()}
    members = {}
    for doc_id, _, component in groups:
        members.setdefault(component, set()).add(doc_id)
    assert all(len(group & left) == 1 for group in members.values()) and len(left) == len(members)
    packed = corpus_pipeline.STAGES[3][1](spark, at, SF).collect()
    assert {row.doc_id for row in packed} == left
    assert corpus_pipeline.run(spark, SF).count() == len(packed)


def test_intermediate_folders_can_be_cleared(spark):
    rows = stored(spark.range(3), "kind")
    (folder,) = {os.path.dirname(file.removeprefix("file://")) for file in rows.inputFiles()}
    assert os.path.isdir(folder)
    clear(spark)
    assert not os.path.exists(folder)
