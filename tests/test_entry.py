"""Driver contract and a few registered queries against DuckDB on sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["cliente_nome", "total_eventos", "total_violacoes", "taxa_violacao_pct"]
    assert df.count() > 0


def test_every_query_has_sql_or_is_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {n for n in q if not n.startswith("op") and n != "pipeline"}
    assert own <= set(o)


def test_entry_works_without_the_text_operators(tmp_path):
    """A copy without the subpackage and the pipeline still imports and lists its queries."""
    import shutil
    import subprocess

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(root, "freightlake"), copy / "freightlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), copy)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), sorted(e.oracle_sql()) == sorted(e.queries()))"],
                          cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert said.stdout.split()[1] == "True", said.stderr


@pytest.mark.parametrize("name", ["sla_rate_by_client", "fact_events", "sla_mart", "gate_failures",
                                  "upsert_newer", "column_tests"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("events", "part", "customer", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    a = sorted((tuple(r[c] for c in sorted(cols)) for r in df.collect()), key=key)
    idx = [cols.index(c) for c in sorted(cols)]
    b = sorted((tuple(r[i] for i in idx) for r in cur.fetchall()), key=key)
    assert len(a) == len(b)
    norm = lambda v: round(float(v), 6) if isinstance(v, float) else v
    assert [tuple(map(norm, r)) for r in a] == [tuple(map(norm, r)) for r in b]
