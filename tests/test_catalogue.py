import os

import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_core_stands_without_the_subpackage():
    import re
    from pathlib import Path

    root = Path(__spark_entry__.__file__).parent / "corpuskit"
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert not re.search(r"corpuskit\.llm|from \.+llm", f.read_text()), f


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", ["q_quality_rollup", "q_exact_dedup", "q_tree_measures", "q_chunk_numbers", "q_token_budget"])
def test_query_matches_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    got, want = __spark_entry__.queries()[name](spark, SF), con.sql(__spark_entry__.oracle_sql()[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(key, got.select(*cols).collect())) == sorted(map(key, want.select(*cols).fetchall()))


def test_entry(spark):
    if os.path.isdir(SF):
        assert __spark_entry__.entry(spark).count() > 0
