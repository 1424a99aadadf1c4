"""The pipeline stage by stage, and the registered queries against their SQL and brute force."""

import os
from collections import Counter

import pytest
from compare import connect, spark_rows, sql_rows
from llm_cases import documents, edge_rows, prose

import corpus_pipeline
from marketspark.llm import queries

FOLDER = "/root/testdata/sf0.01"


def test_stages_are_those_asked_for():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "minhash_dedup", "suffix_dedup", "source_mixing", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_works_on_what_the_one_before_kept(spark, tmp_path):
    rows = edge_rows() + [(7000 + i, prose(i, 60), "en", "abc"[i % 3], 1) for i in range(60)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    start = docs.schema
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == start.names, name
        assert [f.dataType for f in docs.schema] == [f.dataType for f in start], name
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    assert set(kept[0]) == {r[0] for r in rows if any(c.isalpha() for c in r[1] or "")}
    assert set(kept[1]) < set(kept[0]) and 0 in kept[1] and 1 not in kept[1] and 2 not in kept[1]
    assert 9 not in kept[1], "it differs from 8 in three words of thirty thousand"
    assert set(kept[2]) == set(kept[1]) and len(kept[2][13]) < len(kept[1][13])
    assert set(kept[3]) <= set(kept[2])
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {p["doc_id"] for p in pieces} == set(kept[3])
    again = corpus_pipeline.run(spark, str(tmp_path)).collect()

    def tokens(found):
        total = Counter()
        for p in found:
            total[p["doc_id"]] += p["length"]
        return total

    assert tokens(again) == tokens(pieces)


def test_pipeline_of_no_documents(spark, tmp_path):
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_gives_the_rows_of_its_sql(spark, name):
    names, rows = spark_rows(queries.QUERIES[name](spark, FOLDER))
    sql_names, expected = sql_rows(connect(FOLDER), queries.SQL[name])
    assert names == sql_names
    assert rows == expected


def test_one_query_for_each_operator():
    assert {q.split("_")[0] for q in queries.QUERIES} == {"pipeline", *[f"op{n}" for n in range(1, 14)]}
