"""Registered queries with SQL next to it, on the small tables and on odd rows."""

import duckdb
import pytest

from gleaner.llm import jaccard, secret_scan
from gleaner.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_text_operators import DOCS, docs_of, near_copies, secret_texts
from tests.oracle import _rows, compare, duck


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    ok, n, _, detail = compare(spark, name, QUERIES[name], ORACLES[name], SF_SMALL, duck(SF_SMALL))
    assert ok and n > 0, f"{name}: {detail}"


@pytest.mark.parametrize("name,texts,run", [
    ("op3_secret_scan", secret_texts, secret_scan.secret_report), ("op4_ngram_jaccard", near_copies, jaccard.jaccard_components)])
def test_sql_on_odd_rows(spark, tmp_path, name, texts, run):
    docs = docs_of(spark, texts())
    assert docs.schema.simpleString().startswith("struct<" + DOCS.split(",")[0].replace(" long", ":bigint"))
    docs.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    got = run(docs)
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(got.columns)
    assert _rows(cols, res.fetchall()) == _rows(got.columns, [tuple(r) for r in got.collect()])
