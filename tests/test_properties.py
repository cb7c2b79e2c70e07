"""Property-based checks of the keyed operators against plain-Python models."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from freightlake.operators.dedup import latest_per_key
from freightlake.operators.upsert import merge_upsert

KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
WMS = st.one_of(st.none(), st.integers(0, 3))
ROWS = st.lists(st.tuples(KEYS, WMS, st.integers(0, 9)), max_size=8)
SCHEMA = "k string, wm int, v int"
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def model_merge(target, source, newer):
    """MERGE ... ON t.k = s.k WHEN MATCHED AND s.wm > t.wm THEN UPDATE WHEN NOT MATCHED THEN INSERT."""
    out, matched_src = [], set()
    for t in target:
        hits = [i for i, s in enumerate(source) if t[0] is not None and s[0] == t[0]]
        row = t
        for i in hits:
            matched_src.add(i)
            s = source[i]
            if not newer or (s[1] is not None and t[1] is not None and s[1] > t[1]):
                row = s
        out.append(row)
    out += [s for i, s in enumerate(source) if i not in matched_src]
    return sorted(out, key=repr)


def unique_source(rows):
    seen, out = set(), []
    for r in rows:
        if r[0] is None or r[0] not in seen:
            out.append(r)
            if r[0] is not None:
                seen.add(r[0])
    return out


@SETTINGS
@given(target=ROWS, source=ROWS, newer=st.booleans())
def test_merge_matches_model(spark, target, source, newer):
    target, source = unique_source(target), unique_source(source)
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    got = sorted((tuple(r) for r in merge_upsert(t, s, "k", newer="wm" if newer else None).collect()), key=repr)
    assert got == model_merge(target, source, newer)


@SETTINGS
@given(rows=ROWS)
def test_latest_per_key_matches_model(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((tuple(r) for r in latest_per_key(df, "k", "wm", ["v"]).collect()), key=repr)
    best = {}
    for r in rows:  # greatest (wm, v), NULL watermark lowest, NULL keys one group
        rank = (r[1] is not None, r[1] if r[1] is not None else 0, r[2])
        if r[0] not in best or rank > best[r[0]][0]:
            best[r[0]] = (rank, r)
    assert got == sorted((v[1] for v in best.values()), key=repr)
