"""Point-in-time join against a plain loop."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from freightlake.operators.validity import as_of_join

BASE = dt.datetime(2024, 1, 1)
hours = st.integers(0, 24 * 60)


def at(h):
    return None if h is None else BASE + dt.timedelta(hours=h)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), hours)), max_size=25),
       st.dictionaries(st.sampled_from(["a", "b"]), st.lists(hours, min_size=1, max_size=5, unique=True)),
       st.booleans(), st.sampled_from([1, 7]))
def test_equals_a_loop(spark, facts, cuts, open_start, slice_days):
    versions = []
    for key, times in cuts.items():
        edges = ([None] if open_start else []) + sorted(times) + [None]
        versions += [(key, at(lo), at(hi), f"{key}{lo}") for lo, hi in zip(edges, edges[1:])]
    versions.append((None, None, None, "no key"))
    want = []
    for i, (key, h) in enumerate(facts):
        hit = [v for k, lo, hi, v in versions if key is not None and k == key and h is not None
               and (lo is None or lo <= at(h)) and (hi is None or at(h) < hi)]
        want.append((i, hit[0] if hit else None))
    f = spark.createDataFrame([(i, k, at(h)) for i, (k, h) in enumerate(facts)], "id int, k string, ts timestamp_ntz")
    v = spark.createDataFrame(versions, "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, name string")
    got = as_of_join(f, v, "k", "ts", ["name"], slice_days=slice_days)
    assert got.columns == ["id", "k", "ts", "name"]
    assert sorted((r["id"], r["name"]) for r in got.collect()) == want


def test_reversed_and_empty_intervals_and_clashing_names(spark):
    f = spark.createDataFrame([("a", at(5), "mine")], "k string, ts timestamp_ntz, valid_from string")
    v = spark.createDataFrame([("a", at(9), at(1), "reversed"), ("a", at(5), at(5), "empty")],
                              "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, name string")
    row = as_of_join(f, v, "k", "ts", ["name"]).collect()
    assert [(r["valid_from"], r["name"]) for r in row] == [("mine", None)]


def test_the_join_is_by_key_and_slice(spark):
    f = spark.createDataFrame([("a", at(5))], "k string, ts timestamp_ntz")
    v = spark.createDataFrame([("a", at(1), None, "x")], "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, name string")
    plan = as_of_join(f, v, "k", "ts", ["name"])._jdf.queryExecution().optimizedPlan().toString()
    joined = next(line for line in plan.splitlines() if "Join LeftOuter" in line)
    assert "_v_slice" in joined and "_v_key" in joined
