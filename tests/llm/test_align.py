import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from helpers import DOC_SCHEMA, awkward, clashing, empty
from tokenizers import Tokenizer

from freightlake.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE = {chr(x): x for x in _SHOWN} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in _SHOWN)}


def tokens(text, a, b):
    """(id, bytes) of the whole text's tokens, by the libraries alone."""
    ids = a.encode(" " + text, add_special_tokens=False).ids
    one = [(i, bytes(BYTE[c] for c in a.id_to_token(i))) for i in ids]
    two = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
           for i in b.encode(text)]
    return one, two


def brute(rows):
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    found, counts = [], Counter()
    for i, text in rows:
        one, two = tokens(text, a, b) if text else ([], [])
        if not text or not b"".join(x for _, x in one) == b"".join(x for _, x in two) == (" " + text).encode():
            found.append((i, None))
            continue
        owner_a = [k for k, (_, x) in enumerate(one) for _ in x]
        owner_b = [k for k, (_, x) in enumerate(two) for _ in x]
        links = sorted(set(zip(owner_a, owner_b, strict=True)))
        pairs = [(one[p][0], two[q][0]) for p, q in links]
        counts.update(pairs)
        cut = np.array(sorted(set(np.cumsum([len(x) for _, x in one]).tolist()) & set(np.cumsum([len(x) for _, x in two]).tolist())))
        groups, done = [([], []) for _ in cut], [0, 0]
        for side, own in enumerate((one, two)):
            for k, x in own:
                done[side] += len(x)
                groups[int(np.searchsorted(cut, done[side]))][side].append(k)
        found.append((i, (one, two, groups, pairs, links)))
    highest = {}
    for (_, q), n in counts.items():
        highest[q] = max(n, highest.get(q, 0))
    out = []
    for i, v in found:
        if v is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        one, two, groups, pairs, _ = v
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((i, len(one), len(two), len(groups), len(pairs), sum(counts[p] == highest[p[1]] for p in pairs),
                    sum(counts[p] for p in pairs), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str), found


TEXTS = [
    "plain words and  two spaces", " starts with space", "ends with space ", "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b cannot come back",
    "tabs\tand\nlines\n\n and  more", "日本語 テキスト 한국어 🙂🙂 é ̈x", "isn't it's I'LL they've", "x" * 3000, "0123456789 " * 50,
    "nbsp\xa0x \x85 y　z \x1c q", "ﬁ ｆｕｌｌ Å ℃ ²", "\x00 nul ﻿ bom", " ", "\n", "a", "😀", "w " * 400, "a b ​ c", "ß" * 90]


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_equals_brute_force(spark):
    texts = [*TEXTS, *TEXTS[:5], " ".join(TEXTS), "\n".join(TEXTS[5:])]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOC_SCHEMA).repartition(3)
    df = df.unionByName(awkward(spark)).unionByName(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    want, _ = brute(rows_of(df))
    for known in (align.KNOWN, 200, 0):  # all, some and no pairs broadcast
        got = align.align(clashing(df, "id", "row", "a", "n_links"), A, B, known_pairs=known)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_small_tables_and_groups_give_the_same(monkeypatch):
    tok = align._loaded(open(A, "rb").read(), open(B, "rb").read())
    import pyarrow as pa
    ids, sums = pa.array(range(len(TEXTS))), []
    for limit in (1, 10**9):
        monkeypatch.setattr(align, "PIECES", limit)
        monkeypatch.setattr(align, "GROUP", limit)
        table, got = align.Table(tok), []
        for at, texts in align._groups(pa.array(TEXTS)):
            batch = align._group(table, ids.slice(at, len(texts)), texts, at)
            got += [[r[k] for k in ("id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")] for r in batch.column("docs")[0].as_py()]
            if table.full():
                table.empty()
        sums.append(got)
    assert sums[0] == sums[1] and [r[0] for r in sums[0]] == list(range(len(TEXTS)))


def test_links_of_both_kinds(spark):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)], DOC_SCHEMA)
    _, found = brute(rows_of(df))
    overlap = {(r.doc_id, r.a_at, r.b_at): (r.a, r.b, r.value) for r in align.links(df, A, B).collect()}
    want = {(i, p, q): (v[0][p][0], v[1][q][0]) for i, v in found if v for p, q in v[4]}
    assert {k: x[:2] for k, x in overlap.items()} == want
    assert sum(x[2] for x in overlap.values()) == sum(len((" " + t).encode()) for (_, t), (_, v) in zip(rows_of(df), found, strict=True) if v)
    group = {(r.doc_id, r.a_at, r.b_at) for r in align.links(df, A, B, "group").collect()}
    want = set()
    for i, v in found:
        at = [0, 0]
        for g, h in v[2] if v else ():
            want |= {(i, at[0] + p, at[1] + q) for p in range(len(g)) for q in range(len(h))}
            at = [at[0] + len(g), at[1] + len(h)]
    assert group == want


def test_products_equal_dense_ones():
    draw = np.random.default_rng(3)
    for n, m, k in ((1, 1, 1), (7, 5, 9), (40, 30, 20), (3, 0, 4)):
        x, y = draw.random((n, m)) < 0.4, draw.random((m, k)) < 0.4
        a, b = (align.Csr(np.concatenate(([0], np.cumsum(z.sum(1)))), np.nonzero(z)[1], z.shape[1]) for z in (x, y))
        for block in (1, 5, 10**6):
            out = np.zeros((n, k), int)
            for rows, columns, values in align.product(a, b, block):
                out[rows, columns] += values
            assert (out == x.astype(int) @ y.astype(int)).all()
        t = align.transposed(a)
        assert [t.indices[i:j].tolist() for i, j in zip(t.indptr, t.indptr[1:], strict=False)] == [np.flatnonzero(c).tolist() for c in x.T]


def test_empty_table(spark):
    assert align.align(empty(spark), A, B).count() == 0 and align.links(empty(spark), A, B).count() == 0
