"""URL filter: fixed rules first, gradient-boosted trees on lexical features for
the rest.

A rule is a host and a path: it fits its host and all subdomains when the URL's
path starts with the rule's path; of several the longest (host and path) wins.
URLs without a rule get the verdict of gradient-boosted trees on features of the
URL's text: lengths, depth, share of digits, entropy, counts of parameters,
hyphens and labels, and statistics of suffixes and hosts: how many URLs and how many
hosts have the same last host label, how many paths the same host.

The statistics count all URLs and know no labels; what a rule tests (a host, a first path
segment) is no feature, so the trees cannot restate the rules.  Only the trees are learned from a
bounded sample: the ``TRAIN_ROWS`` least distinct URLs by a hash of the URL, each
with the label that more of its rows have (block if equal).

Defined results: NULL URLs and URLs without ``://`` have an empty host and path
and no rule; their features are those of the empty text.  NULL ids and repeated
rows are judged like any row; without URLs of both verdicts in the sample the
score is the share of blocks among all labelled rows (0 without any).  An empty table gives an
empty result; other columns are not read.

At scale: rules and trees are expressions.  The statistics are one map-side-combined
count by host (paths by a sketch of bounded size), added up by suffix.  The sample's URLs
are those below a bound on the hash, set by an estimate of the distinct ones, so few of them
are shuffled.  Tables of hosts and suffixes are broadcast behind a count, else joined.  Very
long URLs are expressions on one string like any other.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlake.llm.common import ASCII_UPPER, if_small, let, stage

# Fixed values: (verdict, host, path) of the rules.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
TRAIN_ROWS, TREES, DEPTH, CUT = 20_000, 12, 3, 0.5
FEATURES = ("url_chars", "host_chars", "path_chars", "depth", "digit_share", "entropy", "n_params", "n_hyphens",
            "n_labels", "longest_label", "has_fragment", "suffix_urls", "suffix_hosts", "host_paths")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), ASCII_UPPER, ASCII_UPPER.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_verdict(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict), NULL where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text).cast("double")
    chars = F.filter(F.split(text, ""), lambda c: c != "")

    def of(cs: Column) -> Column:
        def share(c: Column) -> Column:
            return F.size(F.filter(cs, lambda x: x == c)) / n
        return F.aggregate(F.array_distinct(cs), F.lit(0.0),
                           lambda acc, c: acc - share(c) * F.log2(share(c)))

    return F.when(n > 0, let(chars, of)).otherwise(F.lit(0.0))


def suffix() -> Column:
    """Last label of ``host``."""
    return F.substring_index("host", ".", -1)


def lexical(urls: DataFrame, url_col: str) -> DataFrame:
    """``urls`` with host, path, suffix and the features of the URL alone."""
    host, path = split_url(F.col(url_col))
    u = F.coalesce(F.col(url_col), F.lit(""))
    count = lambda t, others: F.length(F.regexp_replace(t, others, "")).cast("double")
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    out = urls.withColumns({"host": host, "path": path})
    labels = F.split("host", r"\.")
    return out.withColumns({
        "suffix": suffix(), "url_chars": F.length(u).cast("double"), "host_chars": F.length("host").cast("double"),
        "path_chars": F.length("path").cast("double"), "depth": count(F.col("path"), "[^/]+"),
        "digit_share": F.when(F.length(u) > 0, count(u, "[^0-9]+") / F.length(u)).otherwise(F.lit(0.0)),
        "entropy": entropy(u),
        "n_params": F.when(query == "", F.lit(0.0)).otherwise(count(query, "[^&]+") + 1),
        "n_hyphens": count(F.col("host"), "[^-]+"), "n_labels": F.size(labels).cast("double"),
        "longest_label": F.array_max(F.transform(labels, lambda x: F.length(x))).cast("double"),
        "has_fragment": F.contains(u, F.lit("#")).cast("double")})


def host_statistics(urls: DataFrame, url_col: str) -> tuple[DataFrame, DataFrame]:
    """(host, host_paths) and (suffix, suffix_urls, suffix_hosts) over all rows, as
    logarithms; paths are counted by a sketch."""
    host, path = split_url(F.col(url_col))
    hosts = stage(urls.select(host.alias("host"), path.alias("path")).groupBy("host")
                  .agg(F.count("*").alias("n"), F.approx_count_distinct("path").alias("paths")), "hosts")
    suffixes = stage(hosts.groupBy(suffix().alias("suffix")).agg(F.log1p(F.sum("n")).alias("suffix_urls"),
                                                                F.log1p(F.count("*")).alias("suffix_hosts")), "suffixes")
    return hosts.select("host", F.log1p("paths").alias("host_paths")), suffixes


def url_sample(known: DataFrame, url_col: str, rows: int, distinct: int) -> DataFrame:
    """The ``rows`` least distinct URLs by hash, of about ``distinct``: url, label, __order."""
    hashed = known.withColumn("__order", F.xxhash64(F.lit("sample"), url_col))
    if distinct > 4 * rows:  # twice as many as needed are let through
        hashed = hashed.where(F.col("__order") < int(2**65 * rows / distinct) - 2**63)
    return (hashed.groupBy("__order", url_col).agg((F.avg("label") >= 0.5).cast("double").alias("label"))
            .orderBy("__order", url_col).limit(rows))


class UrlModel:
    """Statistics of all ``urls`` and trees learned from (url, label) rows; label 1 is block."""

    def __init__(self, labelled: DataFrame, urls: DataFrame, url_col: str, rows: int = TRAIN_ROWS):
        known = labelled.where(F.col("label").isNotNull()).select(F.col(url_col), F.col("label").cast("double").alias("label"))
        self.hosts, self.suffixes = (if_small(t) for t in host_statistics(urls, url_col))
        n, blocked, distinct = known.agg(F.count("*"), F.sum("label"), F.approx_count_distinct(url_col)).first()
        self.share, self.trees = (blocked or 0.0) / max(n, 1), None
        sample = stage(lexical(url_sample(known, url_col, rows, distinct), url_col), "url-sample")
        if sample.select("label").distinct().count() == 2:
            data = self.vectors(sample).select("features", "label", "__order").coalesce(1).sortWithinPartitions("__order")
            self.trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, checkpointInterval=-1).fit(data)

    def vectors(self, urls: DataFrame) -> DataFrame:
        """``urls`` (with their lexical columns) and their features; hosts and suffixes never counted have none."""
        known = (urls.join(self.hosts, "host", "left").join(self.suffixes, "suffix", "left")
                 .fillna(0.0, ["host_paths", "suffix_urls", "suffix_hosts"]))
        return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(known)

    def score(self, urls: DataFrame) -> DataFrame:
        """``urls`` (with their lexical columns) and the probability of a block."""
        if self.trees is None:
            return urls.withColumn("score", F.lit(float(self.share)))
        found = self.trees.transform(self.vectors(urls))
        return found.withColumn("score", vector_to_array("probability")[1])


def by_rules(pages: DataFrame, url_col: str, rules=RULES) -> DataFrame:
    """(url, label) of the URLs that a rule judges: label 1 is block."""
    host, path = split_url(F.col(url_col))
    urls = pages.select(F.col(url_col), host.alias("host"), path.alias("path"))
    verdict = rule_verdict(F.col("host"), F.col("path"), rules)[1]
    return urls.where(verdict.isNotNull()).select(url_col, (verdict == "block").cast("int").alias("label"))


def judge(pages: DataFrame, labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
          rules=RULES) -> DataFrame:
    """One row for each row of ``pages``: id, host, path, rule, verdict, score.
    ``labelled`` has url and label; without it the trees learn from the URLs
    that the rules judge."""
    urls = pages.select(F.col(url_col))
    model = UrlModel(by_rules(urls, url_col, rules) if labelled is None else labelled, urls, url_col)
    own = lexical(pages.select(F.col(id_col), F.col(url_col)), url_col)
    name, verdict = rule_verdict(F.col("host"), F.col("path"), rules)
    scored = model.score(own.withColumns({"rule": name, "__verdict": verdict}))
    by_score = F.when(F.col("score") >= CUT, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(id_col, "host", "path", "rule", F.coalesce("__verdict", by_score).alias("verdict"), "score")
