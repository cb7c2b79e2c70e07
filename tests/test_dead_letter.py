"""Fields outside the contract are rescued and counted; malformed CSV rows are quarantined in ingest."""

import json

from pyspark.sql import types as T

from freightlake.plans.daily_run import ingest
from freightlake.sources import dead_letter

CONTRACT = (
    "id long, ok boolean, day date, tags array<string>, box struct<w:double,at:struct<x:int>>, price decimal(10,2)")


def lines(spark, tmp_path, rows):
    path = str(tmp_path / "drop.json")
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(path)
    return path


def test_rescued_fields_and_dead_letters(spark, tmp_path):
    rows = ['{"id":1,"ok":true,"day":"2024-01-02","tags":["a"],"box":{"w":2,"at":{"x":3}},"price":1.25}',
            '{"id":"2","ok":"yes","day":"soon","tags":"a","box":{"w":"2","at":{"x":1,"y":[1]},"z":null},"price":7,"new":{"a":1}}',
            '{"id":3,"box":4}', '{"id":null,"box":{"at":5}}', '{}', '{"id":9', '[1]', '7', '', '   ', '{"a b":1.5}']
    good, bad = dead_letter.read_rescued(spark, lines(spark, tmp_path, rows), T.StructType.fromDDL(CONTRACT))
    got = {json.dumps(r.asDict(True), default=str): r for r in good.collect()}
    assert len(got) == 6
    by = {(r.id, json.dumps(json.loads(r._rescued or "{}"), sort_keys=True)): r for r in good.collect()}
    first = by[1, "{}"]
    assert (first.ok, str(first.day), first.tags, first.box.w, first.box.at.x, str(first.price)) == (True, "2024-01-02", ["a"], 2.0, 3, "1.25")
    second = next(r for (i, x), r in by.items() if "new" in x)
    assert json.loads(second._rescued) == {"id": '"2"', "ok": '"yes"', "day": '"soon"', "tags": '"a"', "box.w": '"2"', "box.at.y": "[1]",
                                           "box.z": "null", "new": '{"a":1}'}
    assert (second.id, second.ok, second.day, second.tags, second.box.w, second.box.at.x, float(second.price)) == (None,) * 5 + (1, 7.0)
    third = next(r for (i, _), r in by.items() if i == 3)
    assert third.box is None and json.loads(third._rescued) == {"box": "4"}
    assert sorted((r._error, r._raw) for r in bad.collect()) == [
        ("malformed_record", '{"id":9'), ("not_an_object", "7"), ("not_an_object", "[1]")]
    counts = {(r.path, r.type, r.reason): r.n for r in dead_letter.dead_letters(good).collect()}
    assert counts["new", "OBJECT<a: BIGINT>", "unknown_field"] == 1 and counts["box", "BIGINT", "retyped"] == 1
    assert counts["a b", "DECIMAL", "unknown_field"] == 1 and counts["box.at", "BIGINT", "retyped"] == 1 and len(counts) == 11


def test_observed_schema_and_empty_drop(spark, tmp_path):
    path = lines(spark, tmp_path, ['{"a":1}', '{"a":2.5,"b":"x"}'])
    assert "b: STRING" in dead_letter.observed_schema(spark, path)
    (tmp_path / "empty.json").mkdir()
    spark.createDataFrame([], "value string").write.mode("overwrite").text(str(tmp_path / "empty.json"))
    good, bad = dead_letter.read_rescued(spark, str(tmp_path / "empty.json"), T.StructType.fromDDL(CONTRACT))
    assert good.count() == 0 and bad.count() == 0 and dead_letter.dead_letters(good).count() == 0


def test_ingest_keeps_rescued_fields_and_quarantines_csv(spark, tmp_path):
    schema = T.StructType.fromDDL("k string, updated_at timestamp, n int")
    path = lines(spark, tmp_path, ['{"k":"a","updated_at":"2024-01-01 10:00:00","n":1,"extra":true}',
                                   '{"k":"b","updated_at":"2024-01-01 11:00:00","n":"many"}', '{"k":'])
    table, dead, bad = (str(tmp_path / x) for x in ("table", "dead", "bad"))
    out = ingest(spark, path, table, "d", "k", "updated_at", "run", "2024-01-02 00:00:00", schema=schema,
                 quarantine_path=bad, dead_letter_path=dead, index_buckets=2)
    assert {(r.k, r.n, r._rescued) for r in out["rows"].collect()} == {("a", 1, '{"extra":"true"}'), ("b", None, '{"n":"\\"many\\""}')}
    assert {(r.path, r.type, r.n) for r in spark.read.parquet(dead).collect()} == {("extra", "BOOLEAN", 1), ("n", "STRING", 1)}
    assert [r._raw for r in spark.read.parquet(bad).collect()] == ['{"k":']
    csv = tmp_path / "drop.csv"
    csv.write_text("k,updated_at,n\na,2024-01-01 10:00:00,1\nb,2024-01-01 11:00:00,many\nc,2024-01-01 11:00:00,3\n")
    out = ingest(spark, str(csv), str(tmp_path / "t2"), "d", "k", "updated_at", "run", "2024-01-02 00:00:00", schema=schema,
                 quarantine_path=str(tmp_path / "bad2"), index_buckets=None)
    assert sorted(r.k for r in out["rows"].collect()) == ["a", "c"]
    assert [r._raw for r in spark.read.parquet(str(tmp_path / "bad2")).collect()] == ["b,2024-01-01 11:00:00,many"]
