import re

from helpers import DOC_SCHEMA, awkward, clashing, empty, prose

from freightlake.llm import decontaminate

ITEM = "A train leaves Boston at 9:30 and travels 120 km in 2 hours before it meets Alice near the old stone bridge."


def found(spark, texts, items=(ITEM,)):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOC_SCHEMA)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = decontaminate.matches(df, bench).collect()
    return {(r.doc_id, r.item_id): r for r in rows}


def test_copies_and_exchanged_values(spark):
    filler = prose(30)
    other = ITEM.replace("Boston", "Chicago").replace("Alice", "Bob Smith").replace("120", "3,450").replace("km", "miles")
    r = found(spark, [ITEM, f"{filler}. {ITEM} {filler}", ITEM.upper().lower(), f"{filler}\n{other}", filler, ITEM.split("Alice")[0]])
    assert {k[0] for k in r} == {0, 1, 3, 5} | ({2} if (2, 0) in r else set())
    assert not r[0, 0].exchanged and r[3, 0].exchanged
    assert r[0, 0].n_matched == r[0, 0].n_item


def test_copies_match_in_any_case_wrapping_and_context(spark):
    wrapped = ITEM.replace(" ", "\n")
    copies = [ITEM.lower(), ITEM.upper(), wrapped, ITEM.title(), f"Question: {ITEM}", f"he said {ITEM}"]
    r = found(spark, copies)
    assert {k: (x.n_matched, x.exchanged) for k, x in r.items()} == {(i, 0): (r[0, 0].n_item, False) for i in range(len(copies))}
    leads = ["", "Question: ", "Q: ", "He asked, ", "1) ", "Dear Alice, "]
    for item in ("What is the capital of France?", "Who wrote the novel about the White Whale?", "Add 3 and 4 and 5 and 6"):
        r = found(spark, [lead + x for lead in leads for x in (item, item.lower(), item.upper())], [item])
        assert len(r) == 3 * len(leads)
    r = found(spark, ["Question: What is the capital of Spain?", "we know Paris is the capital of France"], ["What is the capital of France?"])
    assert set(r) == {(0, 0)} and r[0, 0].exchanged


def test_slots_must_be_consistent(spark):
    item = "if 5 apples and 7 pears cost as much as 5 plums then how much do 7 pears and 5 apples cost together"
    same = item.replace("5", "31").replace("7", "12")
    mixed = "if 31 apples and 12 pears cost as much as 44 plums then how much do 90 pears and 55 apples cost together"
    r = found(spark, [same, mixed], [item])
    assert set(r) == {(0, 0)}


def test_one_inconsistent_slot_drops_its_windows_only(spark):
    words = ["".join(chr(97 + int(d)) for d in str(100 + i)) for i in range(50)]
    words[5], words[40] = "5", "5"
    item = " ".join(words)
    verbatim = " ".join([*words[:40], "6", *words[41:]])
    other = " ".join([*words[:5], "7", *words[6:40], "6", *words[41:]])
    r = found(spark, [item, verbatim, other], [item])
    assert {i: (x.n_matched, x.exchanged) for (i, _), x in r.items()} == {0: (50, False), 1: (49, True), 2: (43, True)}


def test_windows_of_placeholders_are_no_evidence(spark):
    item = " ".join(str(i * 37) for i in range(30))
    assert not found(spark, [" ".join(str(i * 11) for i in range(60))], [item])


def test_short_items_and_null_items(spark):
    r = found(spark, ["so the purple gecko sang loudly at noon", "the the the the"], ["the purple gecko sang loudly", "the the", None, ""])
    assert set(r) == {(0, 0)}


def test_verbatim_items_equal_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()}
    plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    items = [(r.item_id, plain(r.text)) for r in bench.collect()]
    want = {(r.doc_id, i) for r in docs.collect() for t in [plain(r.text)] for i, x in items if x in t}
    assert got == want and want


def test_shuffle_join_gives_the_same(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    a = decontaminate.matches(docs, bench).collect()
    monkeypatch.setattr(decontaminate, "BITMAP_BITS", (6, 6))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert sorted(a) == sorted(decontaminate.matches(docs, bench).collect())


def test_clean_keeps_columns_and_awkward_rows(spark):
    df = clashing(awkward(spark), "__t1", "t1", "t2", "hash", "item")
    bench = spark.createDataFrame([(1, "the old harbour lay quiet while seven boats came home from the northern banks")], "item_id long, text string")
    out = decontaminate.clean(df, bench)
    assert out.columns == df.columns and out.count() == df.count() - 4  # the prose rows
    none = bench.where("item_id < 0")
    assert decontaminate.clean(df, none).count() == df.count()
    assert decontaminate.clean(empty(spark), bench).count() == 0


def test_very_short_items(spark):
    items = ["Define photosynthesis briefly", "Name 7 metals", "Explain gravity", "Why?"]
    texts = ["Question: define photosynthesis briefly. Thanks", "name 7 metals", "name 9 metals", "please explain gravity now",
             "Explain gravity!", "why", "why not", "define photosynthesis very briefly"]
    assert set(found(spark, texts, items)) == {(0, 0), (1, 1), (4, 2), (5, 3)}


def letters(n, salt):
    """``n`` different words of letters."""
    return " ".join("".join(chr(97 + int(d)) for d in str(1000 * salt + i + 10**6)) for i in range(n))


def test_wording_of_many_items_is_no_evidence(spark):
    lead = letters(20, 1)
    items = [f"{lead} {letters(3 + i % 20, 100 + i)}" for i in range(60)] + [letters(30, 7)] * 40
    texts = [lead, *[f"so {x} and" for x in items[:60:7]], lead.split()[0], items[-1], f"{letters(9, 3)} {items[-1]}"]
    r = found(spark, texts, items)
    assert set(r) == {(1 + k, i) for k, i in enumerate(range(0, 60, 7))} | {(len(texts) - 2, 60), (len(texts) - 1, 60)}


def test_wording_of_many_items_counts_where_no_limit_is_given(spark):
    lead = letters(20, 1)
    items = [f"{lead} {letters(3 + i % 20, 100 + i)}" for i in range(60)] + [letters(30, 7)] * 40
    texts = [lead, " ".join(lead.split()[:12]), f"so {letters(30, 7)} and", letters(30, 9)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOC_SCHEMA)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    r = {(x.doc_id, x.item_id): x.n_matched for x in decontaminate.matches(df, bench, shared=None).collect()}
    assert r == {(0, i): 20 for i in range(60)} | {(2, i): 30 for i in range(60, 100)}
    assert sorted(x.doc_id for x in decontaminate.clean(df, bench).collect()) == [1, 3]


def test_tokens_equal_a_pattern():
    pattern = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+|[.!?\n]")
    texts = [ITEM, "a1.5b 1..2 3,4:5/6. 7.", "Straße ÀÉ x_y ² ½ ٣٤,٥ 日本語。 e\u0301 A. b!?\n\n", "", "__ ''", "1.2.3.x 9:30am", "\x00a\u2028b"]
    for text in texts:
        t = decontaminate.tokenise(text)
        assert [text[i:j] for i, j in zip(t.start.tolist(), t.end.tolist(), strict=True)] == pattern.findall(text)
    kinds = decontaminate.tokenise("Alice ran 5 Km IBM iPhone A Zürich ÉCOLE.").kind.tolist()
    d = decontaminate
    assert kinds == [d.TITLE, d.LITERAL, d.NUMBER, d.UNIT, d.LITERAL, d.LITERAL, d.LITERAL, d.TITLE, d.LITERAL, d.STOP]


def test_long_texts_in_chunks(monkeypatch):
    text = " ".join(f"Word{i} 3.{i} km.\n" for i in range(300))
    whole = decontaminate.tokenise(text)
    monkeypatch.setattr(decontaminate, "CHUNK", 50)
    for a, b in zip(whole[1:], decontaminate.tokenise(text)[1:], strict=True):
        assert (a == b).all()


def test_texts_in_groups_give_what_each_gives_alone(spark):
    """Neighbours share no window, name, unit or number, and places count from each text's start."""
    a, b = ITEM[:60], ITEM[60:]
    texts = [a, b, None, "", ITEM, f"went 5\n{ITEM}", "red apple", "red", "apple", "Alice", f"Bob {ITEM} 12", "km away.", f"été {ITEM}",
             *(prose(40 + i) for i in range(20)), ITEM.upper()]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, __text string").coalesce(1)
    widths = {decontaminate.FULL: [5, 8], decontaminate.PLAIN: [1, 2, 3, 8]}
    bench = spark.createDataFrame([(0, ITEM), (1, "red apple"), (2, "Alice"), (3, "one two three"), (4, "what is 5 km")], "item long, __text string")
    items = decontaminate._scan(bench, ["item"], None, None)
    bitmap = spark.sparkContext.broadcast(decontaminate._bitmap(items, items.count()))
    together = list(decontaminate._groups(texts, False))
    assert len(together) == 1 and together[0][0] == list(range(len(texts)))

    grouped = sorted(tuple(r) for r in decontaminate._scan(df, ["id"], widths, bitmap).collect())
    hashes = {r["hash"] for r in items.collect()}
    each = spark.createDataFrame(spark.sparkContext.parallelize(list(enumerate(texts)), len(texts)), df.schema)
    alone = [tuple(r) for r in decontaminate._scan(each, ["id"], widths, bitmap).collect()]
    assert grouped == sorted(alone)
    exact = [r for r in grouped if r[7] in hashes]
    assert {r[0] for r in exact} >= {4, 5, 6, 9, 10, 12} and {r[0] for r in exact}.isdisjoint({2, 3, 7, 8, 11})
    assert len(grouped) - len(exact) <= 2  # both bitmaps let hardly any other window through
