"""The registered queries on the smallest driver tables."""

import math
import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from playstats.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(round(r[i], 9) if isinstance(r[i], float) and not math.isnan(r[i]) else r[i]
                             for i in order)) for r in rows)


def test_one_query_for_each_operator():
    assert [sum(k.startswith(f"op{n}_") for k in LLM_QUERIES) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in LLM_QUERIES and set(LLM_QUERIES) <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_dedup", "decontamination", "bpe"]


@pytest.mark.parametrize("key", sorted(LLM_ORACLE_SQL))
def test_equals_sql(spark, key):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    df = LLM_QUERIES[key](spark, SF)
    res = con.execute(LLM_ORACLE_SQL[key])
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag([d[0] for d in res.description], res.fetchall())


@pytest.mark.parametrize("key", sorted(set(LLM_QUERIES) - set(LLM_ORACLE_SQL) - {"pipeline"}))
def test_one_row_a_document(spark, key):
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    assert sorted(r.doc_id for r in LLM_QUERIES[key](spark, SF).select("doc_id").collect()) == ids
