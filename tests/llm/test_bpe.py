import hashlib
import random

import pytest
import regex
from helpers import awkward, clashing, empty

from freightlake.llm import bpe

tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def ranks():
    with open(tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return bpe.read_ranks(f.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_replay_equals_the_library_word_by_word(ranks, library):
    draw = random.Random(3)
    words = {"".join(draw.choice("aeiostnrl") for _ in range(draw.randrange(1, 25))) for _ in range(4000)}
    words |= {"".join(chr(draw.randrange(0x20, 0x3000)) for _ in range(draw.randrange(1, 12))) for _ in range(2000)}
    words |= {"a" * n for n in range(1, 80)} | {" " * n for n in range(1, 80)} | {"ab" * 40, "aab" * 33, "=" * 301, "é" * 77}
    words = [w.encode() for w in words]
    replay = bpe.MergeReplay(ranks)
    for word, ids in zip(words, replay.encode(words), strict=True):
        assert ids == library._core_bpe.encode_single_piece(word)
        assert replay.decode(ids) == word


def test_a_merge_that_opens_a_lower_rank_follows_the_words_own_order():
    # merging (a, b) as rank 300 opens (ab, c) as rank 290, which comes before other places of (a, b)
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 310, b"ab": 300, b"abc": 290, b"bcab": 280}
    replay = bpe.MergeReplay(ranks)
    for word in (b"abcab", b"ababc", b"abcabc", b"bcabab"):
        assert replay.encode([word])[0] == replay.encode_one(word)


def test_long_texts_run_in_slices(monkeypatch, ranks, library):
    text = " ".join(f"word{i} \n" for i in range(3000))
    split = regex.compile(tokenizers.PATTERN)
    monkeypatch.setattr(bpe, "SLICE", 100)
    monkeypatch.setattr(bpe, "HELD", 250)
    find = lambda t: (m.group() for m in split.finditer(t))
    (got,) = bpe.encode_texts([text], find, bpe.WordTable(bpe.MergeReplay(ranks)), True)
    ids = library.encode_ordinary(text)
    assert got == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256(text.encode()).hexdigest(), ids)


def test_documents_and_round_trip(spark, library):
    path = tokenizers.path("byte_bpe_50k.tiktoken")
    df = clashing(awkward(spark), "n_tokens", "ids").unionByName(
        clashing(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "n_tokens", "ids"))
    out = bpe.encode(df, path, tokenizers.PATTERN, passed=("doc_id", "text"), with_ids=True).cache()
    for r in out.collect():
        ids = library.encode_ordinary(r.text or "")
        assert (r.n_tokens, list(r.ids)) == (len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    back = bpe.decode(out.withColumnRenamed("text", "original"), path, passed=("doc_id", "original")).collect()
    assert all(r.text == (r.original or "") for r in back)
    assert bpe.encode(empty(spark), path, tokenizers.PATTERN).count() == 0
