"""The registered queries: against their SQL, and for rows."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from checks.compare import differences, frame, oracle, rows
from skyload.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    assert differences(rows(QUERIES[name](spark, SF)), frame(oracle(SF), ORACLES[name])) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_a_row_for_each_document(spark, name):
    got = [r["doc_id"] for r in QUERIES[name](spark, SF).collect() if name != "op12_pack_sequences" or not r["start"]]
    assert sorted(got) == sorted(r[0] for r in duckdb.sql(f"SELECT doc_id FROM '{SF}/documents.parquet'").fetchall())
