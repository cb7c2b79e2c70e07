"""Byte-level BPE by corpus-level merge replay.

A task gathers the distinct words of its share of the corpus and writes them one
behind the other as byte tokens.  An inverted index leads from each mergeable
pair, named by the rank of the token it makes, to its places.  The replay goes
through the ranks in order: a merge is applied at all its places at once, and
only the two neighbours of each place are looked up anew and enter the index.
Ranks are held in blocks: places found for a later block are sorted into it when
the current block is done.  In a word where a merge makes a pair of a lower
rank than its own, the order among the word's places matters; such words are
done again on their own, lowest rank first, leftmost first.  Texts are then
written from the table of words, and decoded from the ids.

Defined results: NULL text is the empty text: no ids, digests of no bytes; NULL
ids and repeated rows pass like any row; an empty table gives an empty result;
other columns are not read unless named.  Very long texts are cut into slices of
matches; digests run on from slice to slice.

At scale: no shuffle; the vocabulary (a fixed file, under 1 MB) is broadcast.  A
task holds word numbers of a bounded stretch of texts, one bounded replay, and a
bounded table of words.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from freightlake.llm.common import python_workers

#: New words of one replay, words kept in a worker's table, matches held before
#: texts are written, and matches of one slice of a long text.
REPLAY_WORDS, TABLE_WORDS, HELD, SLICE = 100_000, 200_000, 4_000_000, 500_000


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Ranks of a file of lines "base64 rank"."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in raw.splitlines() if x)}


class MergeReplay:
    """Encodes sets of words by replaying merges over all of them at once."""

    #: Stands between words; no pair with it merges.  NONE: no rank.
    GAP, NONE, BLOCK = (1 << 31) - 1, (1 << 31) - 2, 512

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        made = {}
        for whole, r in ranks.items():
            for k in range(1, len(whole)):
                a, b = ranks.get(whole[:k]), ranks.get(whole[k:])
                if a is not None and b is not None:
                    made[a << 31 | b] = r
        self.made = made
        self.pairs = np.array(sorted(made), dtype=np.int64)
        self.pair_rank = np.array([made[x] for x in self.pairs.tolist()], dtype=np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of what the pairs make."""
        key = (a << 31) | b
        at = np.searchsorted(self.pairs, key)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == key, self.pair_rank[at], self.NONE)

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word."""
        rest = [k for k, w in enumerate(words) if w not in self.ranks]
        out = [None if w not in self.ranks else [self.ranks[w]] for w in words]
        if not rest:
            return out
        sizes = np.array([len(words[k]) for k in rest], dtype=np.int64)
        starts = np.cumsum(sizes + 1) - sizes  # a gap before each word, one at the end
        n = int(starts[-1] + sizes[-1]) + 1
        tokens = np.full(n, self.GAP, dtype=np.int64)
        inside = np.ones(n, dtype=bool)
        inside[starts - 1] = inside[n - 1] = False
        tokens[inside] = self.byte[np.frombuffer(b"".join(words[k] for k in rest), dtype=np.uint8)]
        left, right = np.arange(-1, n - 1), np.arange(1, n + 1)
        made = np.full(n, self.NONE, dtype=np.int64)  # rank of the pair that begins here
        made[:-1] = self.rank(tokens[:-1], tokens[1:])
        places = np.flatnonzero(made != self.NONE)
        index: dict[int, list[np.ndarray]] = {}  # block of ranks -> arrays of places, each with its rank
        self._file(index, made[places], places)
        again: list[np.ndarray] = []
        blocks = list(index)
        heapq.heapify(blocks)
        while blocks:
            block = heapq.heappop(blocks)
            later_ranks, later_places = [], []
            end = (block + 1) * self.BLOCK
            ranks, places = (np.concatenate(x) for x in zip(*index.pop(block), strict=True))
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = np.flatnonzero(np.diff(ranks, prepend=-1))
            here = {r: [x] for r, x in zip(ranks[cuts].tolist(), np.split(places, cuts[1:]), strict=True)}
            queue = list(here)
            heapq.heapify(queue)
            while queue:
                r = heapq.heappop(queue)
                found = here.pop(r)
                at = np.unique(found[0] if len(found) == 1 else np.concatenate(found))
                at = at[made[at] == r]
                if not len(at):
                    continue
                gone = right[at]
                if (gone[:-1] == at[1:]).any():  # a pair of equal tokens, in runs: leftmost first
                    at = self._apart(at, gone)
                    gone = right[at]
                after = right[gone]
                next_to = np.flatnonzero(after[:-1] == at[1:])  # on the way, before the second of two merges
                if len(next_to):
                    way = self.rank(np.full(len(next_to), r), tokens[at[next_to + 1]])
                    again.append(at[next_to][way < r])
                tokens[at], tokens[gone], made[gone] = r, -1, self.NONE
                right[at], left[after] = after, at
                before = left[at]
                r_left = self.rank(tokens[before], tokens[at])
                r_right = self.rank(tokens[at], tokens[after])
                made[before] = r_left
                made[at] = r_right
                new_ranks, new_places = np.concatenate((r_left, r_right)), np.concatenate((before, at))
                some = new_ranks != self.NONE
                new_ranks, new_places = new_ranks[some], new_places[some]
                if not len(new_ranks):
                    continue
                low = new_ranks < r
                if low.any():
                    again.append(new_places[low])
                near = (new_ranks < end) & ~low
                if near.any():
                    for x, p in zip(new_ranks[near].tolist(), new_places[near].tolist(), strict=True):
                        if x in here:
                            here[x].append(np.array([p]))
                        else:
                            here[x] = [np.array([p])]
                            heapq.heappush(queue, x)
                far = new_ranks >= end
                later_ranks.append(new_ranks[far])
                later_places.append(new_places[far])
            if later_ranks:
                for b in self._file(index, np.concatenate(later_ranks), np.concatenate(later_places)):
                    heapq.heappush(blocks, b)
        redo = set(np.searchsorted(starts, np.concatenate(again), side="right").tolist()) if again else set()
        left_over = tokens[(tokens >= 0) & (tokens != self.GAP)]
        counts = np.add.reduceat(((tokens >= 0) & (tokens != self.GAP)).astype(np.int64), starts)
        ids, at = left_over.tolist(), 0
        for j, (k, m) in enumerate(zip(rest, counts.tolist(), strict=True)):
            out[k] = self.encode_one(words[k]) if j + 1 in redo else ids[at:at + m]
            at += m
        return out

    def _file(self, index: dict, ranks: np.ndarray, places: np.ndarray) -> list[int]:
        """Put places into the index by block of their rank; returns blocks that are new there."""
        if not len(ranks):
            return []
        block = ranks // self.BLOCK
        order = np.argsort(block, kind="stable")
        block, ranks, places = block[order], ranks[order], places[order]
        cuts = np.flatnonzero(np.diff(block, prepend=-1))
        new = []
        for b, x, p in zip(block[cuts].tolist(), np.split(ranks, cuts[1:]), np.split(places, cuts[1:]), strict=True):
            if b not in index:
                index[b] = []
                new.append(b)
            index[b].append((x, p))
        return new

    @staticmethod
    def _apart(at: np.ndarray, gone: np.ndarray) -> np.ndarray:
        """Of places whose pairs overlap, every other one of each run."""
        linked = np.concatenate(([False], gone[:-1] == at[1:]))
        number = np.arange(len(at))
        begin = np.maximum.accumulate(np.where(linked, 0, number))
        return at[(number - begin) % 2 == 0]

    def encode_one(self, word: bytes) -> list[int]:
        """Ids of one word: lowest rank first, leftmost first."""
        tokens = [self.GAP, *self.byte[np.frombuffer(word, dtype=np.uint8)].tolist(), self.GAP]
        n, made = len(tokens), self.made.get
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(r, p) for p in range(n - 1) if (r := made(tokens[p] << 31 | tokens[p + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            r, p = heapq.heappop(queue)
            if tokens[p] < 0 or right[p] >= n or made(tokens[p] << 31 | tokens[right[p]]) != r:
                continue
            gone = right[p]
            tokens[p], tokens[gone], right[p] = r, -1, right[gone]
            left[right[p]] = p
            if (new := made(tokens[left[p]] << 31 | r)) is not None:
                heapq.heappush(queue, (new, left[p]))
            if (new := made(r << 31 | tokens[right[p]])) is not None:
                heapq.heappush(queue, (new, p))
        return [t for t in tokens[1:-1] if t >= 0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class WordTable(dict):
    """word -> its number; ``learn`` fills what belongs to new numbers: ids,
    their text with a space before each, their bytes, how many they are."""

    def __init__(self, replay: MergeReplay):
        super().__init__()
        self.replay = replay
        self.ids: list[list[int]] = []
        self.texts: list[str] = []
        self.bytes: list[bytes] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n

    def new(self) -> int:
        return len(self) - len(self.ids)

    def learn(self) -> None:
        words = [w.encode() for w in itertools.islice(self, len(self.ids), None)]
        for at in range(0, len(words), REPLAY_WORDS):
            for ids in self.replay.encode(words[at:at + REPLAY_WORDS]):
                self.ids.append(ids)
                self.texts.append("".join([f" {i}" for i in ids]))
                self.bytes.append(self.replay.decode(ids))

    def forget(self, limit: int = TABLE_WORDS) -> None:
        """Empty the table when it has more words; no numbers may be in use."""
        if len(self) > limit:
            self.clear()
            self.ids, self.texts, self.bytes = [], [], []


@functools.lru_cache(maxsize=1)
def replay_of(raw: bytes) -> MergeReplay:
    """The merges of a vocabulary; a worker keeps them from task to task."""
    return MergeReplay(read_ranks(raw))


class Digest:
    """Of one text, slice by slice: number of ids, digests, ids on request."""

    def __init__(self, with_ids: bool):
        self.n, self.of_ids, self.of_bytes = 0, hashlib.sha256(), hashlib.sha256()
        self.ids: list[int] | None = [] if with_ids else None

    def add(self, table: WordTable, numbers: list[int]) -> None:
        joined = "".join([table.texts[i] for i in numbers])
        self.of_ids.update((joined if self.n else joined[1:]).encode())
        self.of_bytes.update(b"".join([table.bytes[i] for i in numbers]))
        self.n += joined.count(" ")
        if self.ids is not None:
            self.ids.extend(itertools.chain.from_iterable([table.ids[i] for i in numbers]))

    def row(self) -> tuple:
        return self.n, self.of_ids.hexdigest(), self.of_bytes.hexdigest(), self.ids


def encode_texts(texts: list[str], find: Callable, table: WordTable, with_ids: bool) -> list[tuple]:
    """(n_tokens, ids_sha256, decoded_sha256, ids or None) of each text.
    ``find(text)`` gives an iterator over the words, or a list."""
    digests = [Digest(with_ids) for _ in texts]
    held, n_held = [], 0

    def write() -> None:
        nonlocal n_held
        table.learn()
        for k, numbers in held:
            digests[k].add(table, numbers.tolist())
        held.clear()
        n_held = 0
        table.forget()

    for k, text in enumerate(texts):
        matches = find(text)
        slices = [matches] if isinstance(matches, list) else iter(lambda: list(itertools.islice(matches, SLICE)), [])
        for words in slices:
            numbers = np.fromiter(map(table.__getitem__, words), dtype=np.int32, count=len(words))
            held.append((k, numbers))
            n_held += len(numbers)
            if n_held >= HELD or table.new() >= REPLAY_WORDS:
                write()
    write()
    return [d.row() for d in digests]


def gathered(batches: Iterator[pa.RecordBatch], chars: int = 12_000_000) -> Iterator[pa.Table]:
    """Batches put together up to so many bytes: a replay costs less for each
    word the more words it has."""
    some, size = [], 0
    for batch in batches:
        some.append(batch)
        size += batch.nbytes
        if size >= chars:
            yield pa.Table.from_batches(some)
            some, size = [], 0
    if some:
        yield pa.Table.from_batches(some)


def encode(df: DataFrame, vocabulary: str, pattern: str, text_col: str = "text",
           passed: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """The passed columns with n_tokens, ids_sha256, decoded_sha256 and, on
    request, ids (array of int).

    ``vocabulary`` is the path of a ranks file on the driver; ``pattern`` splits
    texts into words that are encoded separately.
    """
    spark: SparkSession = df.sparkSession
    python_workers(spark)
    with open(vocabulary, "rb") as f:
        raw = spark.sparkContext.broadcast(f.read())  # a fixed file
    given = df.select(*passed, df[text_col].alias("__text"))
    made = [("n_tokens", T.LongType(), pa.int64()), ("ids_sha256", T.StringType(), pa.string()),
            ("decoded_sha256", T.StringType(), pa.string()),
            ("ids", T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))][:3 + with_ids]
    schema = T.StructType([*given.schema.fields[:-1], *(T.StructField(n, t) for n, t, _ in made)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split = regex.compile(pattern)

        def find(text: str):
            return split.findall(text) if len(text) <= SLICE else (m.group() for m in split.finditer(text))

        table = WordTable(replay_of(raw.value))
        for rows in gathered(batches):
            found = encode_texts([t or "" for t in rows.column("__text").to_pylist()], find, table, with_ids)
            rows = rows.drop_columns(["__text"])
            for k, (name, _, kind) in enumerate(made):
                rows = rows.append_column(name, pa.array([x[k] for x in found], kind))
            yield from rows.to_batches()
        table.forget(0)  # an idle worker holds no words

    return given.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", passed: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The passed columns with the text of ids (NULL ids: NULL text)."""
    spark = df.sparkSession
    python_workers(spark)
    with open(vocabulary, "rb") as f:
        raw = spark.sparkContext.broadcast(f.read())
    given = df.select(*passed, df[ids_col].alias("__ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {r: t for t, r in read_ranks(raw.value).items()}
        for batch in batches:
            texts = [None if x is None else b"".join(token[i] for i in x).decode("utf-8", "replace")
                     for x in batch.column("__ids").to_pylist()]
            rows = pa.Table.from_batches([batch]).drop_columns(["__ids"])
            yield from rows.append_column("text", pa.array(texts, pa.string())).to_batches()

    return given.mapInArrow(run, T.StructType([*given.schema.fields[:-1], T.StructField("text", T.StringType())]))
