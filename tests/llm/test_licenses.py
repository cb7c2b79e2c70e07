import random
import re

from helpers import DOC_SCHEMA, awkward, clashing, empty

from freightlake.llm import licenses


def scan(spark, *texts):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOC_SCHEMA)
    return [r for r in sorted(licenses.scan_licenses(df).collect(), key=lambda r: r.doc_id)]


def brute_base(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    hits = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    return (len(w), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None),
            ",".join(sorted({x for _, x in hits})))


def test_base_phrases(spark):
    texts = ["CC-BY cc by", "All rights\nReserved. all rights all rights reserved", "GNU General Public License; General public", "",
             None, "cc", "by cc", "Kcc by", "general PUBLIC license cc—by cc_by", "ccby cc by"]
    for text, r in zip(texts, scan(spark, *texts), strict=True):
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))


def test_templates_by_diagonals(spark):
    whole = "Released under the MIT License."
    inserted = "This work is licensed under the very GNU General Public License, truly version 3"
    part = "licensed under the Apache"
    rows = scan(spark, f"Intro words. {whole}", inserted, part, whole.upper(), "under the moon released the license")
    assert rows[0].labels == "mit" and rows[0].score == 1.0 and rows[0].n_spans == 1
    assert rows[1].labels == "gpl,gpl-notice"
    assert rows[2].labels == "" and rows[2].score == 0.0
    assert rows[3].labels == "mit"
    assert rows[4].labels == "" and rows[4].n_base == 0


def test_places_of_one_template_are_spans_of_their_own(spark):
    gap = " filler" * 40
    (r,) = scan(spark, f"released under the mit license{gap} released under the mit license")
    assert r.n_spans == 2


def brute_spans(text):
    """(label, coverage) of verified bases, by plain loops over words and diagonals."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    labels, best = set(), 0.0
    for label, body in licenses.TEMPLATES:
        t = body.split()
        hits = {(i - k, k) for i in range(len(w) - 2) for k in range(len(t) - 2) if w[i:i + 3] == t[k:k + 3]}
        for base in {d for d, _ in hits}:
            behind, words = -1, set()
            for k in range(len(t) - 2):
                places = [d + k for d, at in hits if at == k and base <= d <= base + licenses.SLACK]
                if places and min(places) > behind:
                    words |= {k, k + 1, k + 2}
                behind = max([behind, *([min(places)] if places else [])])
            if len(words) / len(t) >= 0.7:
                labels.add(label)
                best = max(best, len(words) / len(t))
    return labels, best


def test_spans_against_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(60):
        w = []
        for _ in range(rng.randint(1, 4)):
            t = rng.choice(licenses.TEMPLATES)[1].split()
            for _ in range(rng.randint(0, 3)):  # words inserted, lost, moved
                k = rng.randrange(len(t))
                t = rng.choice([t[:k] + ["more"] * rng.randint(1, 8) + t[k:], t[:k] + t[k + 1:], t[k:] + t[:k]]) or ["none"]
            w += t + ["filler"] * rng.randint(0, 5)
        texts.append(" ".join(w))
    for text, r in zip(texts, scan(spark, *texts), strict=True):
        labels, best = brute_spans(text)
        base = set(filter(None, r.base_labels.split(",")))
        assert set(filter(None, r.labels.split(","))) == base | labels, text
        assert r.score == (1.0 if base else best)


def test_strewn_and_shuffled_grams_are_no_notice(spark):
    t = dict((label, body) for label, body in licenses.TEMPLATES)["mpl"].split()
    grams = [t[k:k + 3] for k in (0, 2, 4, 6, 9)]
    strewn = " ".join(" ".join(g * 200) for g in grams)
    backwards = " ".join(" ".join(g) for g in reversed([t[k:k + 3] for k in range(0, len(t) - 2, 3)]))
    rows = scan(spark, strewn, backwards, " ".join(t))
    assert [r.labels for r in rows] == ["", "", "mpl"] and [r.n_spans for r in rows] == [0, 0, 1]


def test_awkward_rows_and_empty_table(spark):
    df = clashing(awkward(spark), "n_words", "base", "hits", "row", "id")
    out = licenses.scan_licenses(df).collect()
    assert len(out) == df.count() and all(0 <= r.score <= 1 for r in out)
    assert {(r.n_words, r.labels, r.first_word) for r in out if r.doc_id in (3, 4)} == {(0, "", None)}
    assert licenses.scan_licenses(empty(spark)).count() == 0
