"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

``base_counts`` gives the counts every rule reads.  Each further rule is a
predicate that rejects a document.  ``order_rules`` runs every rule on a bounded
sample, times it and counts its rejections, and sorts the rules by rejection
per cost; ``cascade`` chains them in that order in one CASE expression, so that
a document leaves at the first rule that rejects it and dear rules see few
documents.  A document's verdict is the conjunction of all rules, whatever
their order: the sample changes the cost, never the result.

Defined results: NULL or empty text has zero words and fails the base rule;
NULL ids and repeated rows are judged like any row; an empty table gives an
empty result and the rules in their given order; columns of the input that
clash with a result column are dropped from ``judge``'s result.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlake.llm.common import GAP, let, stage, word_list

MIN_WORDS = 50
SYMBOLS = r"[#*$%&|<>]"


def _covered(starts: Column, width: int) -> Column:
    """How many positions windows of ``width`` cover that begin at these sorted
    starts."""
    begin = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last"))
    return F.aggregate(
        starts, begin,
        lambda a, p: F.struct((a["n"] + F.least(F.lit(width), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"])


def repeated_words(words: Column) -> Column:
    """Words in three-word windows found twice or more in the list, first
    occurrences included.  ``words`` must be a bound value (a column or a lambda
    variable).  Windows are compared by 64-bit hash within one document."""
    grams = F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )).otherwise(F.array().cast("array<bigint>"))

    def among(g: Column) -> Column:
        placed = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(placed, in_runs))

    def in_runs(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), lambda q: _covered(q, 3))

    return let(grams, among)


def base_counts(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_lines (with a word),
    n_dup_lines, n_repeat_words and n_run_words (equal to the word before)."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_lines(ls: Column) -> Column:
        return F.struct(F.size(ls).cast("long").alias("all"),
                        (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("dup"))

    def of_words(w: Column) -> Column:
        return let(let(lines, of_lines), lambda ln: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            ln["all"].alias("n_lines"),
            ln["dup"].alias("n_dup_lines"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.filter(w, lambda x, i: F.when(i > 0, F.get(w, i - 1) == x).otherwise(F.lit(False))))
            .cast("long").alias("n_run_words")))

    return let(word_list(text, GAP), of_words)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


@dataclass(frozen=True)
class Rule:
    """``rejects(text, counts)`` is true for documents to drop; never NULL."""

    name: str
    rejects: Callable[[Column, Column], Column]


def _count(text: Column, others: str) -> Column:
    return F.length(F.regexp_replace(text, others, ""))


RULES = (
    Rule("letters", lambda t, s: 10 * _count(t, r"[^\p{L}]+") < 6 * s["word_chars"]),
    Rule("shouting", lambda t, s: 2 * _count(t, r"[^A-Z]+") > s["word_chars"]),
    Rule("exclamations", lambda t, s: 2 * _count(t, r"[^!]+") > s["n_words"]),
    Rule("symbols", lambda t, s: 10 * s["n_symbols"] > 3 * s["n_words"]),
    Rule("word_length", lambda t, s: (s["word_chars"] < 2 * s["n_words"]) | (s["word_chars"] > 20 * s["n_words"])),
    Rule("repeated_lines", lambda t, s: (s["n_dup_lines"] >= 3) & (10 * s["n_dup_lines"] > 3 * s["n_lines"])),
    Rule("word_runs", lambda t, s: 5 * s["n_run_words"] > s["n_words"]),
)


def order_rules(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES,
                sample_rows: int = 200, longest: int = 50_000, repeats: int = 20) -> list[dict]:
    """Rules sorted by rejection per cost on a sample.

    The sample is bounded: at most ``sample_rows`` documents of at most
    ``longest`` characters, taken from the first partitions that have them.
    Each rule is run ``repeats`` times over it; its cost is the wall time beyond
    that of an empty rule.  Returns dicts of rule, rejected (share), cost
    (seconds) and rank (rejected per cost), best first.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = [(r[0],) for r in df.where(F.length(text) <= longest).select(text).limit(sample_rows).collect()]
    if not rows:
        return [{"rule": r, "rejected": 0.0, "cost": 0.0, "rank": 0.0} for r in rules]
    sample = stage(spark.createDataFrame(rows, "t string")
                   .select("t", base_counts(F.col("t")).alias("s"))
                   .select("t", "s", F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("k")), "rule-sample")

    def run(predicate: Column) -> tuple[float, float]:
        began = time.perf_counter()
        share = sample.agg(F.avg(predicate.cast("int"))).first()[0]
        return float(share), time.perf_counter() - began

    empty = F.length("t") < 0
    run(empty)
    floor = min(run(empty)[1] for _ in range(2))
    found = []
    for rule in rules:
        share, took = run(rule.rejects(F.col("t"), F.col("s")))
        cost = max(took - floor, 1e-4)
        found.append({"rule": rule, "rejected": share, "cost": cost, "rank": share / cost})
    return sorted(found, key=lambda x: -x["rank"])


def cascade(text: Column, counts: Column, ordered: list[Rule]) -> Column:
    """Name of the first rule that rejects, NULL if none; later rules are not
    evaluated."""
    out = F.when(base_failed(counts), F.lit("base"))
    for rule in ordered:
        out = out.when(rule.rejects(text, counts), F.lit(rule.name))
    return out


def judge(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES,
          sample_rows: int = 200) -> DataFrame:
    """Columns of ``df`` with the base counts, base_failed and kept."""
    ordered = [x["rule"] for x in order_rules(df, text_col, rules, sample_rows)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    own = {*names, "base_failed", "kept", "__counts", "__first"}
    passed = [c for c in df.columns if c.lower() not in own]
    if text_col not in passed:
        raise ValueError(f"{text_col} is a result column of this operator; rename it")
    counted = df.select(*passed, base_counts(F.col(text_col)).alias("__counts"))
    counts = F.col("__counts")
    judged = counted.select(*passed, "__counts", cascade(text, counts, ordered).alias("__first"))
    return judged.select(
        *passed, *[counts[n].alias(n) for n in names],
        base_failed(counts).alias("base_failed"), F.col("__first").isNull().alias("kept"))


def keep_good(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that no rule rejects, with all their columns."""
    ordered = [x["rule"] for x in order_rules(df, text_col)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.where(let(base_counts(F.col(text_col)), lambda s: cascade(text, s, ordered).isNull()))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
r AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1)
  GROUP BY doc_id),
s AS (
  SELECT w.doc_id, t, words, lines,
         len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
b AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR 10 * length(regexp_replace(t, '[^\p{L}]', '', 'g')) < 6 * word_chars
            OR 2 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > word_chars
            OR 2 * length(regexp_replace(t, '[^!]', '', 'g')) > n_words
            OR 10 * n_symbols > 3 * n_words
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * len(lines))
            OR 5 * len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) > n_words) AS kept
FROM b
"""
