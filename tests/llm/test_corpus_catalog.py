"""Registered corpus queries against their SQL, and the pipeline stage by stage."""

import pytest
from oracle_check import connect, difference

import corpus_pipeline
from footfall.llm.catalog import ORACLES, QUERIES
from footfall.llm.decontamination import leaks_sql
from footfall.llm.mixing import mix_sql
from footfall.llm.ngrams import components_sql

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_all_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark, tmp_path):
    con = connect(SF)
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{place}")
        docs = spark.read.parquet(f"{tmp_path}/{place}")
        con.execute(f"CREATE VIEW s{place} AS SELECT * FROM read_parquet('{tmp_path}/{place}/*.parquet')")
        seen.append(docs)
        if place < 4:
            assert docs.columns == columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    # few labels teach little here: test_quality_on_held_out_labels has more
    good, kept_good = con.execute(
        "SELECT count(*), count(*) FILTER (doc_id IN (SELECT doc_id FROM s0)) FROM labels WHERE quality = 1"
    ).fetchall()[0]
    assert kept_good >= 0.97 * good and seen[0].count() < 200
    one = con.execute(f"SELECT min(doc_id) FROM ({components_sql('s0')}) GROUP BY component_id").fetchall()
    assert ids(seen[1]) == sorted(r[0] for r in one)
    clean = con.execute(f"SELECT doc_id FROM s1 WHERE doc_id NOT IN (SELECT doc_id FROM ({leaks_sql('s1')}))").fetchall()
    assert ids(seen[2]) == sorted(r[0] for r in clean) and len(clean) < seen[1].count()
    assert difference(seen[3], con, f"SELECT {', '.join(columns)} FROM ({mix_sql('s2', '*')})") is None
    assert ids(seen[4]) == ids(seen[3])
    run = corpus_pipeline.run(spark, SF)
    assert difference(run, con, "SELECT * FROM s4") is None


def test_pipeline_on_odd_tables(spark, odd, none, tmp_path):
    for name, docs in (("odd", odd), ("none", none)):
        for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            if place < 4:
                assert out.columns == docs.columns
            out.write.parquet(f"{tmp_path}/{name}/{place}")
            docs = spark.read.schema(out.schema).parquet(f"{tmp_path}/{name}/{place}")
        if name == "none":
            assert docs.count() == 0


