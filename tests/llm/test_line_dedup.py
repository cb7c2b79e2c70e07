from helpers import DOC_SCHEMA, awkward, brute_lines, clashing, empty

from freightlake.llm import line_dedup


def check(df):
    given = [(r.doc_id, r.text) for r in df.collect()]
    want = sorted(((i, *x) for (i, _), x in zip(given, brute_lines(given), strict=True)), key=str)
    got = sorted(((r.doc_id, r.text, r.n_removed) for r in line_dedup.dedup_lines(df, counts=True).collect()), key=str)
    assert got == want


def test_awkward_rows(spark):
    check(awkward(spark).coalesce(1))


def test_overlapping_and_chained_windows(spark):
    texts = ["a\nb\nc\nd", "x\na\nb\nc\nd\ny", "b\nc\nd", "a\n\n b \n\nc\nz", "a\na\na\na\na", "q\na\na\na", None, "", "c\nd\ny\nb\nc\nd"]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOC_SCHEMA).coalesce(1)
    check(df)


def test_hot_passage_and_repeated_rows(spark):
    rows = [(i % 150, f"head {i}\none\ntwo\nthree\ntail {i % 7}", "en", "s", 0) for i in range(300)]
    check(spark.createDataFrame(rows, DOC_SCHEMA).coalesce(1))


def test_columns_pass_through(spark):
    df = clashing(awkward(spark), "row", "covered", "h1", "__row", "n")
    out = line_dedup.dedup_lines(df)
    assert out.columns == df.columns and out.count() == df.count()


def test_empty_table(spark):
    assert line_dedup.dedup_lines(empty(spark)).count() == 0
