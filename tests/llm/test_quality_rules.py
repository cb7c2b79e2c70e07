from collections import Counter

import pytest
from helpers import awkward, clashing, empty, words_of

from freightlake.llm import quality


def brute_counts(text):
    text = text or ""
    w = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    repeated = {p for i, g in enumerate(grams) if often[g] > 1 for p in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))


def test_counts_match_brute_force(spark):
    texts = ["a b c a b c a b c", "a a a a a", "x y z x y z q", "", "one\n\none\ntwo # $%", None, "p q r s p q r t p q"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, awkward(spark).schema).union(awkward(spark))
    found = quality.judge(df.select("doc_id", "text")).collect()
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_awkward_rows_keep_their_columns(spark):
    df = clashing(awkward(spark), "kept", "n_words", "__counts")
    out = quality.judge(df)
    assert out.count() == df.count() and out.columns.count("kept") == 1
    good = quality.keep_good(df)
    assert good.columns == df.columns
    # the prose documents stay, repeated rows included
    assert sorted(r.doc_id or 0 for r in good.where("text like 'the old harbour%'").collect()) == [0, 1, 2, 2]


def test_empty_table(spark):
    assert quality.judge(empty(spark)).count() == 0
    assert quality.keep_good(empty(spark)).count() == 0


def test_text_column_must_not_be_a_result(spark):
    with pytest.raises(ValueError):
        quality.judge(awkward(spark).withColumnRenamed("text", "kept"), text_col="kept")


def test_order_is_by_rejection_per_cost_and_changes_no_verdict(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ranks = [x["rank"] for x in quality.order_rules(docs)]
    assert ranks == sorted(ranks, reverse=True) and ranks[0] > 0
    forward = quality.judge(docs, rules=quality.RULES).select("doc_id", "kept").collect()
    back = quality.judge(docs, rules=quality.RULES[::-1]).select("doc_id", "kept").collect()
    assert sorted(forward) == sorted(back)


def test_labelled_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    out = quality.judge(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = out.where("not base_failed").select("quality", "kept").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.05
