import os
import sys

import pytest
from helpers import awkward, brute_components, brute_lines, clashing, empty

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from freightlake.llm import decontaminate, quality  # noqa: E402
from freightlake.llm.common import stage  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_stage_against_brute_force_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, function in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = stage(function(spark, docs, SF), f"test-{name}")
        after = [tuple(r) for r in docs.collect()]
        if name != "byte_bpe":
            assert docs.columns == columns
        ids = lambda rows: sorted(r[0] for r in rows)
        pairs = [(r[0], r[1]) for r in before]
        if name == "quality_rules":
            kept = quality.judge(spark.createDataFrame(pairs, "doc_id long, text string")).where("kept").collect()
            assert ids(after) == sorted(r.doc_id for r in kept) and len(after) < len(before)
        elif name == "line_dedup":
            assert sorted((r[0], r[1]) for r in after) == sorted((i, t) for (i, _), (t, _) in zip(pairs, brute_lines(pairs), strict=True))
        elif name == "near_dedup":
            roots, _ = brute_components(pairs, 5, 80)
            least = {}
            for (i, _), r in zip(pairs, roots, strict=True):
                least[r] = min(i, least.get(r, i))
            assert ids(after) == sorted(least.values())
        elif name == "decontamination":
            bench = [decontaminate.TOKEN.findall(r.text.lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            flat = [" ".join(x for x in b if x not in ".!?\n") for b in bench]
            plain = lambda t: " ".join(x for x in decontaminate.TOKEN.findall(t.lower()) if x not in ".!?\n")
            assert ids(after) == sorted(i for i, t in pairs if not any(f in plain(t) for f in flat))
        else:
            assert ids(after) == ids(before)


def test_stages_on_awkward_and_empty_tables(spark):
    for df in (clashing(awkward(spark), "kept", "id", "row", "t1", "ids", "__row", "set_key"), clashing(empty(spark), "kept", "id")):
        docs = stage(df, "test-awkward")
        for name, function in corpus_pipeline.STAGES[:-1]:
            docs = stage(function(spark, docs, SF), f"test-{name}")
            assert docs.columns == df.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_registered(spark):
    names = entry.queries()
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op1_quality_rules", "op3_line_dedup", "op4_license_scan", "op5_minhash_near_dedup"])
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    columns = sorted(d[0] for d in cur.description)
    at = [[d[0] for d in cur.description].index(c) for c in columns]
    want = sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=str)
    df = entry.queries()[name](spark, SF)
    assert sorted(df.columns) == columns
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == want
