"""Alignment of two tokenizers by token-byte incidence matrices.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (pieces with
byte fallback) the text, before which it puts a space itself.  Each gives a sparse
matrix in CSR form with a row for a token and its bytes as columns.  The product
A * B^T, made row by row as Gustavson does it (for each byte of the row, add B^T's row
of that byte), has an entry for each pair of tokens that overlap, the number of shared
bytes: the overlap links.  Byte offsets where tokens of both end cut the tokens into
groups; the product of the two token-group incidences gives the shared-group links.

Texts are cut before each single space between two other non-space characters.  No
token of A and no piece of B reaches over such a place (B's vocabulary is searched for
pieces that would when it is loaded), so the pieces of text between the cuts are
encoded on their own, each distinct one once in a task; the matrices of a batch of new
ones are one block-diagonal product.  Documents add up their pieces.

The count of an id pair is the number of links in the whole corpus.  The encoding pass
writes its documents in groups of bounded size: the distinct pieces' links, as
numbers of the group's distinct id pairs, the pieces of each document, and how often each
pair stands in the group.  Spark adds up the latter and marks the highest of each B id.
A second pass reads the groups and looks up the counts: the most frequent pairs, at
most ``KNOWN``, in a broadcast table; links of all others leave the task as rows (id
pair and number) and are joined with the counts.

Defined results: NULL and empty texts, and texts whose tokens do not give back the
bytes, have no tokens: zeros and ''.  NULL ids and repeated rows are rows like any
other and count as often as they stand; an empty table gives an empty result; other
columns are not read, whatever their names.  Very long texts are encoded in pieces;
one piece, a stretch without single spaces, is held whole.

At scale: the vocabulary files (fixed, some 2 MB) are broadcast; a task's table of
pieces is emptied beyond a bound; the pair table has at most |A| * |B| rows whatever the
corpus, and shuffles one row for each task and pair.  A B id's pairs (at most |A|) meet
in one window.  The groups written take about half the size of the texts.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freightlake.llm.common import python_workers, stage

#: Pieces and characters of a task's table, characters of a group of documents (a longer
#: one is a group of its own), pairs broadcast, and entries of one block of a product.
PIECES, CHARS, GROUP, KNOWN, BLOCK = 400_000, 16_000_000, 2_000_000, 1 << 19, 1 << 20
CUT = re.compile(r"(?<=\S) (?=\S)")


class Csr(NamedTuple):
    """A 0/1 matrix by rows: the columns of row i are indices[indptr[i]:indptr[i + 1]]."""

    indptr: np.ndarray
    indices: np.ndarray
    columns: int


def incidence(ends: np.ndarray) -> Csr:
    """Rows that hold consecutive columns up to these ends."""
    n = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate(([0], ends)).astype(np.int64), np.arange(n), n)


def membership(column: np.ndarray, columns: int) -> Csr:
    """One column for each row."""
    return Csr(np.arange(len(column) + 1), column.astype(np.int64), columns)


def transposed(m: Csr) -> Csr:
    rows = np.repeat(np.arange(len(m.indptr) - 1), np.diff(m.indptr))
    counts = np.bincount(m.indices, minlength=m.columns)
    return Csr(np.concatenate(([0], np.cumsum(counts))), rows[np.argsort(m.indices, kind="stable")], len(m.indptr) - 1)


def product(a: Csr, b: Csr, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, columns and values of a * b, sorted, in blocks of whole rows of about so
    many products."""
    sizes = np.diff(b.indptr)[a.indices]
    done = np.concatenate(([0], np.cumsum(sizes)))[a.indptr]
    at, n = 0, len(a.indptr) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(done, done[at] + block, side="right")) - 1)
        inner = a.indices[a.indptr[at]:a.indptr[to]]
        size = sizes[a.indptr[at]:a.indptr[to]]
        rows = np.repeat(np.repeat(np.arange(at, to), np.diff(a.indptr[at:to + 1])), size)
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        key = rows * b.columns + b.indices[np.repeat(b.indptr[inner], size) + step]
        if (np.diff(key) < 0).any():
            key.sort()
        first = np.flatnonzero(np.diff(key, prepend=-1))
        key, values = key[first], np.diff(first, append=len(key))
        yield key // max(1, b.columns), key % max(1, b.columns), values
        at = to


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True  # their strings in texts are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        # byte-level alphabet: printable bytes stand for themselves, the others for code points from 256
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [x for x in range(256) if x not in shown]
        byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(other)}
        entries = {i: w for w, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [bytes(byte[c] for c in entries[i]) if i in entries and all(c in byte for c in entries[i])
                        else entries.get(i, "").encode() for i in range(max(entries) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece reaches over a space: texts cannot be cut there")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_size, self.a_start, self.a_flat = self._flat(self.a_bytes)
        self.b_size, self.b_start, self.b_flat = self._flat(self.b_bytes)
        # ids as text, before another of the group and as the last
        self.a_more, self.a_last = self._texts(len(self.a_bytes), b","), self._texts(len(self.a_bytes), b"|")
        self.b_more, self.b_last = self._texts(len(self.b_bytes), b","), self._texts(len(self.b_bytes), b";")

    @staticmethod
    def _flat(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([len(x) for x in tokens])
        return size, np.cumsum(size) - size, np.frombuffer(b"".join(tokens), dtype=np.uint8)

    @staticmethod
    def _texts(n: int, end: bytes) -> np.ndarray:
        return np.array([b"%d%s" % (i, end) for i in range(n)], dtype=object)

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B one piece after the other, their numbers for each piece (zero
        unless both give back a space and the piece), and whether they do."""
        given = [" " + p for p in pieces]
        a = [e.ids for e in self.a.encode_batch_fast(given, add_special_tokens=False)]
        b = self.b.encode(pieces, num_threads=1)
        want = np.frombuffer("".join(given).encode(), dtype=np.uint8)
        length = np.array([len(g) if g.isascii() else len(g.encode()) for g in given], dtype=np.int64)
        ok = np.ones(len(pieces), dtype=bool)
        out = []
        for ids, size, start, flat in ((a, self.a_size, self.a_start, self.a_flat), (b, self.b_size, self.b_start, self.b_flat)):
            n = np.array([len(x) for x in ids], dtype=np.int64)
            ids = np.fromiter((i for x in ids for i in x), np.int64, int(n.sum()))
            piece = np.repeat(np.arange(len(pieces)), n)
            sizes = size[ids]
            same = np.bincount(piece, weights=sizes, minlength=len(pieces)).astype(np.int64) == length
            keep, good = same[piece], np.repeat(same, length)
            own = sizes[keep]
            at = np.repeat(start[ids[keep]] - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))
            differ = flat[at] != want[good]
            same[np.repeat(np.arange(len(pieces)), length)[good][differ]] = False
            ok &= same
            out.append((ids, n, piece))
        (a, n_a, a_piece), (b, n_b, b_piece) = out
        return a[ok[a_piece]], b[ok[b_piece]], np.where(ok, n_a, 0), np.where(ok, n_b, 0), ok


class Aligned(NamedTuple):
    """Tokens of several pieces one behind the other: ids, ends in bytes, groups, and the piece of each."""

    a: np.ndarray
    b: np.ndarray
    a_end: np.ndarray
    b_end: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    groups: int

    def overlap(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        return product(incidence(self.a_end), transposed(incidence(self.b_end)))

    def written(self, tok: Tokenizers) -> list[bytes]:
        """All ids in the order a1,a2|b1;a3|b2; as text."""
        a_last, b_last = np.diff(self.a_group, append=self.groups) > 0, np.diff(self.b_group, append=self.groups) > 0
        before = np.cumsum(np.bincount(self.a_group, minlength=self.groups))  # tokens of A up to each group
        b_at = np.arange(len(self.b)) + before[self.b_group]
        out = np.empty(len(self.a) + len(self.b), dtype=object)
        a_at = np.ones(len(out), dtype=bool)
        a_at[b_at] = False
        out[a_at] = np.where(a_last, tok.a_last[self.a], tok.a_more[self.a])
        out[b_at] = np.where(b_last, tok.b_last[self.b], tok.b_more[self.b])
        return out.tolist()

    def shared_group(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        return product(membership(self.a_group, self.groups), transposed(membership(self.b_group, self.groups)))


def align_ids(a: np.ndarray, b: np.ndarray, tok: Tokenizers) -> Aligned:
    """``a`` and ``b`` are ids of the same bytes."""
    a_end, b_end = np.cumsum(tok.a_size[a]), np.cumsum(tok.b_size[b])
    cuts = np.intersect1d(a_end, b_end, assume_unique=True)
    return Aligned(a, b, a_end, b_end, np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end), len(cuts))


class Table(dict):
    """Piece -> number; what is known of each piece by number."""

    def __init__(self, tok: Tokenizers):
        super().__init__()
        self.tok = tok
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.new, self.chars = [], 0
        self.ok = np.zeros(0, bool)
        self.sizes = np.zeros((4, 0), np.int64)  # n_a, n_b, n_groups, n_links
        self.groups: list[bytes] = []
        self.codes: list[np.ndarray] = []  # id pairs of the links of all pieces, by batch

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.new.append(piece)
        self.chars += len(piece)
        return n

    def full(self) -> bool:
        return len(self) > PIECES or self.chars > CHARS

    def learn(self) -> None:
        """Encodes and aligns the new pieces."""
        if not self.new:
            return
        a, b, n_a, n_b, ok = self.tok.encode(self.new)
        n, self.new = len(self.new), []
        al = align_ids(a, b, self.tok)
        a_piece = np.repeat(np.arange(n), n_a)
        codes, counts = [], np.zeros(n, np.int64)
        for rows, columns, _ in al.overlap():
            codes.append(al.a[rows] << 32 | al.b[columns])
            counts += np.bincount(a_piece[rows], minlength=n)
        n_groups = np.bincount(a_piece[np.flatnonzero(np.diff(al.a_group, prepend=-1))], minlength=n)
        text, at = al.written(self.tok), np.concatenate(([0], np.cumsum(n_a + n_b))).tolist()
        self.groups += [b"".join(text[i:j]) for i, j in zip(at, at[1:], strict=False)]
        self.codes.append(np.concatenate([*codes, np.zeros(0, np.int64)]))
        self.ok = np.concatenate((self.ok, ok))
        self.sizes = np.concatenate((self.sizes, np.stack([n_a, n_b, n_groups, counts])), axis=1)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of these sizes."""
    done = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(sizes)
    return done[ends] - done[ends - sizes]


@functools.lru_cache(maxsize=1)
def _loaded(a_file: bytes, b_file: bytes) -> Tokenizers:
    return Tokenizers(a_file, b_file)


def _groups(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Place and texts of groups of at most GROUP characters or one text."""
    at, chars, held = 0, 0, []
    for k, t in enumerate(texts):
        t = t.as_py()
        if held and chars + len(t or "") > GROUP:
            yield at, held
            at, chars, held = k, 0, []
        held.append(t)
        chars += len(t or "")
    if held:
        yield at, held


def _files(docs: DataFrame, a_path: str, b_path: str):
    """Broadcasts of the two vocabulary files."""
    sc = docs.sparkSession.sparkContext
    out = []
    for path in (a_path, b_path):
        with open(path, "rb") as f:
            out.append(sc.broadcast(f.read()))
    return out


def _binary(values: np.ndarray, kind: str) -> bytes:
    return values.astype(kind).tobytes()


def encoded(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    """A row for each group of documents: docs (with n_a, n_b, n_groups, n_links, digest and
    the numbers of their pieces), n_links of each piece, its links as numbers of id pairs, the
    pairs (a << 32 | b) and how often each stands in the group."""
    python_workers(docs.sparkSession, 64)
    a_file, b_file = _files(docs, a_path, b_path)
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(_loaded(a_file.value, b_file.value))
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 40
        for batch in batches:
            for at, texts in _groups(batch.column("text")):
                ids = batch.column("id").slice(at, len(texts))
                yield _group(table, ids, texts, row)
                row += len(texts)
                if table.full():
                    table.empty()

    kind = given.schema["id"].dataType.simpleString()
    one = f"id:{kind},row:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string,pieces:binary"
    return given.mapInArrow(run, f"docs array<struct<{one}>>, n_links binary, links binary, pairs binary, times binary")


def _group(table: Table, ids: pa.Array, texts: list[str | None], row: int) -> pa.RecordBatch:
    none = np.zeros(0, np.int64)
    each = [np.fromiter(map(table.__getitem__, CUT.split(t)), np.int64) if t else none for t in texts]
    table.learn()
    each = [p if table.ok[p].all() else none for p in each]
    own, at, n = np.unique(np.concatenate([*each, none]), return_inverse=True, return_counts=True)
    n_links = table.sizes[3, own]
    starts = np.cumsum(table.sizes[3]) - table.sizes[3]
    if len(table.codes) > 1:
        table.codes = [np.concatenate(table.codes)]
    links = np.repeat(starts[own] - (np.cumsum(n_links) - n_links), n_links) + np.arange(int(n_links.sum()))
    pairs, link = np.unique(np.concatenate([*table.codes, none])[links], return_inverse=True)
    times = np.bincount(link, weights=np.repeat(n, n_links), minlength=len(pairs))
    sizes = np.stack([table.sizes[:, p].sum(axis=1) for p in each])
    digests = [hashlib.sha256(b"".join([table.groups[k] for k in p.tolist()])[:-1]).hexdigest() if len(p) else "" for p in each]
    ends = np.cumsum([len(p) for p in each]).tolist()
    pieces = [_binary(at[j - len(p):j], "<i4") for p, j in zip(each, ends, strict=True)]
    one = pa.StructArray.from_arrays(
        [ids, pa.array(np.arange(row, row + len(texts))), *(pa.array(sizes[:, i]) for i in range(4)), pa.array(digests, pa.string()),
         pa.array(pieces, pa.binary())], names=["id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pieces"])
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), one), pa.array([_binary(n_links, "<i4")], pa.binary()),
         pa.array([_binary(link, "<i4")], pa.binary()), pa.array([_binary(pairs, "<i8")], pa.binary()),
         pa.array([_binary(times, "<i8")], pa.binary())],
        names=["docs", "n_links", "links", "pairs", "times"])


def pair_counts(groups: DataFrame) -> DataFrame:
    """(a, b, n, best): links of each id pair in the corpus; best if no other pair of that b has more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        none = np.zeros(0, np.int64)

        def summed() -> tuple[np.ndarray, np.ndarray]:
            codes, n = np.concatenate([none, *(c for c, _ in held)]), np.concatenate([none, *(t for _, t in held)])
            order = np.argsort(codes, kind="stable")
            first = np.flatnonzero(np.diff(codes[order], prepend=-1))
            return codes[order][first], np.add.reduceat(n[order], first) if len(first) else none

        for batch in batches:
            for pairs, times in zip(batch.column("pairs"), batch.column("times"), strict=True):
                held.append((np.frombuffer(pairs.as_py(), "<i8"), np.frombuffer(times.as_py(), "<i8")))
            if sum(len(c) for c, _ in held) > BLOCK:
                held[:] = [summed()]
                if len(held[0][0]) > BLOCK // 2:
                    yield _pairs(*held.pop())
        yield _pairs(*summed())

    python_workers(groups.sparkSession, 16)
    sums = groups.select("pairs", "times").mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return sums.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def _pairs(codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    a, b = (codes >> 32).astype(np.int32), (codes & 0xFFFFFFFF).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], names=["a", "b", "n"])


def _frequent(pairs: DataFrame, most: int) -> tuple[tuple[np.ndarray, ...], bool]:
    """Codes, counts and marks of the pairs with at least 2^p links, at most ``most``; whether these are all."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = dict(map(tuple, pairs.groupBy(power.alias("p")).agg(F.count("*")).collect()))  # at most 64 rows
    least, total = 64, 0
    for p in sorted(sizes, reverse=True):
        total += sizes[p]
        if total > most:
            break
        least = p
    t = pairs.where(power >= least).toArrow()
    codes = t.column("a").to_numpy().astype(np.int64) << 32 | t.column("b").to_numpy().astype(np.int64)
    order = np.argsort(codes)
    return (codes[order], t.column("n").to_numpy()[order], t.column("best").to_numpy()[order].astype(np.int64)), total <= most


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          known_pairs: int = KNOWN) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row."""
    groups = stage(encoded(docs, a_path, b_path, id_col, text_col), "aligned-groups")
    pairs = stage(pair_counts(groups), "pairs")
    frequent, all_known = _frequent(pairs, known_pairs)
    known = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, best = known.value
        for batch in batches:
            for group in range(batch.num_rows):
                n_links, links, pairs = (np.frombuffer(batch.column(c)[group].as_py(), k).astype(np.int64)
                                         for c, k in (("n_links", "<i4"), ("links", "<i4"), ("pairs", "<i8")))
                at = np.searchsorted(codes, pairs)
                hit = np.zeros(len(pairs), bool)
                inside = at < len(codes)
                hit[inside] = codes[at[inside]] == pairs[inside]
                value = np.zeros((2, len(pairs)), np.int64)
                value[0, hit], value[1, hit] = best[at[hit]], counts[at[hit]]
                per_piece = [_sums(v[links], n_links) for v in value]
                one = batch.column("docs")[group].values
                pieces = [np.frombuffer(x, "<i4") for x in one.field("pieces").to_pylist()]
                sums = [pa.array(np.array([int(v[p].sum()) for p in pieces], dtype=np.int64)) for v in per_piece]
                rest = [[] for _ in pieces]
                if not hit.all():
                    starts = np.cumsum(n_links) - n_links
                    lost = _sums(~hit[links], n_links) > 0
                    for k, p in enumerate(pieces):
                        own = [links[starts[i]:starts[i] + n_links[i]] for i in p[lost[p]].tolist()]
                        own = np.concatenate([np.zeros(0, np.int64), *own])
                        pair, times = np.unique(own[~hit[own]], return_counts=True)
                        rest[k] = [{"a": x >> 32, "b": x & 0xFFFFFFFF, "times": n}
                                   for x, n in zip(pairs[pair].tolist(), times.tolist(), strict=True)]
                kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("times", pa.int64())]))
                yield pa.RecordBatch.from_arrays([*(one.field(c) for c in copied), *sums, pa.array(rest, kind)],
                                                 names=[*copied, "n_best", "count_sum", "rest"])

    copied = ["id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kind = docs.schema[id_col].dataType.simpleString()
    python_workers(docs.sparkSession, 16)
    scored = groups.drop("times").mapInArrow(
        run, f"id {kind}, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, "
             "count_sum long, rest array<struct<a:int,b:int,times:long>>")
    names = ["n_a", "n_b", "n_groups", "n_links"]
    if all_known:
        return scored.select(F.col("id").alias(id_col), *names, "n_best", "count_sum", "groups_sha256")
    scored = stage(scored, "aligned")
    left = (scored.select("row", F.inline("rest")).join(pairs, ["a", "b"]).groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                 F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    return (scored.drop("rest").join(left, "row", "left")
            .select(F.col("id").alias(id_col), *names, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                    (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256"))


def links(docs: DataFrame, a_path: str, b_path: str, kind: str = "overlap", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, a_at, b_at (places of the tokens from 0), a, b (ids), value for each overlap link (value: shared bytes) or
    shared-group link (``kind="group"``; value 1).  Rows leave the task by blocks of the product."""
    python_workers(docs.sparkSession, 64)
    a_file, b_file = _files(docs, a_path, b_path)
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _loaded(a_file.value, b_file.value)
        for batch in batches:
            for k, text in enumerate(batch.column("text").to_pylist()):
                if not text:
                    continue
                a, b, _, _, ok = tok.encode(CUT.split(text))
                if not ok.all():
                    continue
                al = align_ids(a, b, tok)
                for rows, columns, values in al.overlap() if kind == "overlap" else al.shared_group():
                    ids = batch.column("id").take(pa.array(np.full(len(rows), k)))
                    yield pa.RecordBatch.from_arrays(
                        [ids, *(pa.array(x.astype(np.int64)) for x in (rows, columns, al.a[rows], al.b[columns], values))],
                        names=["id", "a_at", "b_at", "a", "b", "value"])

    out = given.mapInArrow(run, f"id {given.schema['id'].dataType.simpleString()}, a_at long, b_at long, a long, b long, value long")
    return out.withColumnRenamed("id", id_col)
