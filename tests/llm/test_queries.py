"""Every query of the subpackage on the smallest tables: against its SQL, or its counts against the tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from gatelog.llm.queries import EXPECTED, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    relation = con.execute(EXPECTED[name])
    columns = sorted(d[0] for d in relation.description)
    order = [[d[0] for d in relation.description].index(c) for c in columns]
    want = sorted((tuple(row[i] for i in order) for row in relation.fetchall()), key=repr)
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == columns
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == want


def test_registered():
    assert set(entry_points.queries()) >= {*QUERIES, "pipeline"}
    assert entry_points.oracle_sql().keys() >= EXPECTED.keys()
    assert [name.split("_")[0] for name in QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_pipeline(spark):
    """Each stage keeps the columns of documents, works on what the one before kept, and its decisions take effect."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    counts = [kept.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF_DIR)
        assert after.columns == docs.columns, name
        rows = after.collect()
        kept = spark.createDataFrame(rows, docs.schema)
        counts.append(len(rows))
        assert len({r.doc_id for r in rows}) == len(rows)
    assert counts == sorted(counts, reverse=True) and counts[-1] < counts[0]
    result = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in result) == sorted(r.doc_id for r in rows)
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert not any(item in (r.text or "") for item in items for r in rows)
