"""Benchmark decontamination by template windows.

Texts are tokenised; numbers, names and units become typed placeholders, all
other words are lower-cased.  A number is a run of digits with inner separators,
a unit a unit word right after a number, a name a run of capitalised words not
at a sentence's start.  As case and the token before decide what a name is,
every text has a second, plain form: all words lower-cased, only numbers become
placeholders, so copies match whatever their case, line breaks and lead-in.
Windows of consecutive tokens of either form are hashed and documents are
hash-joined with the benchmark.  A window must hold at least as many literal words
as placeholders; one of the plain form with more numbers stands as literal text.
An item's capitalised first word, which is a name after other words, is also
indexed as such, for that same word only.  On each diagonal (place in the document
minus place in the item) the values in the slots are checked: an item's value
must stand for one and the same value of the document throughout.  Windows with
an exchanged value that breaks this are dropped; the diagonal's other windows
(without slots, unchanged, or consistent) are evidence.  A document
is contaminated by an item when the windows left, of both forms and all
diagonals together, cover at least ``least`` words of the item, or all of a shorter one; so a question whose
numbers or names were exchanged is caught like a verbatim copy.  With ``shared=None`` (the registered
queries and ``clean``) every window is evidence for every item it stands in, however many these are;
items of equal text are matched once and then all named.  ``matches`` by itself takes windows that stand
in more than ``SHARED`` items (instructions before many questions) for no evidence; of such an
item the words of its other windows count.

Defined results: NULL or empty texts match nothing; items of three words match where these
stand one after the other, numbers as they are, items of one or two words only a text of
just these; items shorter than a
window are one window of their own length; very long texts are read in chunks; an exchanged name is not seen where a
capitalised first word stands before a name and follows other words, or where a
line break stands before the name in one of the texts only.  NULL ids and repeated rows are
judged like any row (the result has one row for each id, text and item); an
empty documents or benchmark table gives an empty result (``clean`` then keeps
all rows); other columns are not read.

At scale: the benchmark is the small side.  Documents are read once, words are found and
hashed by numpy over code points, in groups of texts with line feeds between; two bitmaps of
the benchmark's window hashes (sized to their number, put together in tasks, at most 32 MB
each) drop nearly all windows inside the task;
what is left is joined by Spark, with a broadcast behind a check of the size.
Groups are one document's matches on one item.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.llm.common import fresh, let, python_workers, stage
from freightlake.llm.minhash import _mix, text_key

WINDOW, SHORTEST, WHOLE, LEAST = 8, 4, 2, 13
#: Windows that stand in more items than this are wording that no item owns.
SHARED = 16
BITMAP_BITS = (18, 28)
BYTES_FROM_WORDS = 1 << 16
BROADCAST_WINDOWS = 200_000

# Unit words.
UNITS = frozenset("""
mm cm m km inch inches foot feet yard yards mile miles metre metres meter meters kilometre kilometres kilometer
kilometers mg g kg gram grams kilogram kilograms ton tons tonne tonnes ounce ounces pound pounds ml l litre litres liter liters
gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years
percent degree degrees dollar dollars cent cents euro euros usd eur mph kmh watt watts kw volt volts
""".split())

LITERAL, NUMBER, UNIT, TITLE, STOP = range(5)
FULL, PLAIN, LITERALS = range(3)
#: What placeholders hash to.
NUMBER_HASH, UNIT_HASH, NAME_HASH = (np.uint64(0x6A09E667F3BCC908 + i) for i in range(3))

# What a character can be: in a word, a decimal digit, a sentence's end, a separator
# inside numbers, upper and lower case.
LETTER, DIGIT, END, INNER, UPPER, LOWER = (1 << i for i in range(6))
CHUNK = 1 << 20
#: Short texts are worked on together, up to so many characters.
GROUP = 1 << 15
#: What ``tokenise`` finds, as a pattern.
TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+|[.!?\n]")
FACTOR = 0x9E3779B97F4A7C15


class Characters(NamedTuple):
    """By code point: flags, and a hash of the lower-case character."""

    flags: np.ndarray
    hashes: np.ndarray


@functools.cache
def characters() -> Characters:
    flags, lower = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint64)
    for i in range(0x110000):
        c = chr(i)
        if c.isalnum():
            flags[i] = (DIGIT if c.isdecimal() else LETTER) | UPPER * (c.isupper() or c.istitle()) | LOWER * c.islower()
            if len(c.lower()) == 1:
                lower[i] = ord(c.lower())
    for c in ".!?\n":
        flags[ord(c)] |= END
    for c in ".,:/":
        flags[ord(c)] |= INNER
    with np.errstate(over="ignore"):
        return Characters(flags, _mix(lower * np.uint64(FACTOR) + np.uint64(1)))


@functools.lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of FACTOR and of its inverse."""
    out = []
    for base in (FACTOR, pow(FACTOR, -1, 1 << 64)):
        x = np.full(n, np.uint64(base))
        x[0] = 1
        with np.errstate(over="ignore"):
            out.append(np.cumprod(x))
    return tuple(out)


class Tokens(NamedTuple):
    """Words, numbers and sentence ends of a text: places, kinds, and hashes in lower case."""

    text: str
    start: np.ndarray
    end: np.ndarray
    kind: np.ndarray
    value: np.ndarray

    def words(self, a: int, b: int) -> list[str]:
        return [self.text[i:j] for i, j, k in zip(self.start[a:b].tolist(), self.end[a:b].tolist(), self.kind[a:b].tolist(), strict=True)
                if k != STOP]


#: Which class of token a character's flags make it part of; 0: of none.
_GROUPS = np.array([DIGIT if f & DIGIT else LETTER if f & LETTER else f & END for f in range(64)], dtype=np.uint8)


def _chunk(text: str) -> tuple[np.ndarray, ...]:
    known = characters()
    cp = np.frombuffer(text.encode(), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le"), "<u4")
    n = len(cp)
    flags = np.zeros(n + 1, np.uint8)
    flags[:n] = known.flags[cp]
    group = np.zeros(n + 2, np.uint8)
    group[1:-1] = _GROUPS[flags[:n]]
    at = np.flatnonzero(flags & INNER) + 1  # separators between digits belong to the number
    group[at[(group[at - 1] == DIGIT) & (group[at + 1] == DIGIT)]] = DIGIT
    own, change = group[1:-1], group[1:] != group[:-1]
    alone = own == END
    inside = own > 0
    start = np.flatnonzero(inside & (change[:-1] | alone))
    end = np.flatnonzero(inside & (change[1:] | alone)) + 1
    power, inverse = _powers(max(1 << 12, 1 << n.bit_length()))
    with np.errstate(over="ignore"):
        done = np.zeros(n + 1, np.uint64)
        np.cumsum(known.hashes[cp] * power[:n], out=done[1:])
        value = _mix((done[end] - done[start]) * inverse[start] + (end - start).astype(np.uint64))
    kind = np.full(len(start), LITERAL, np.int8)
    if len(start):
        spans = np.stack((start + 1, end), axis=1).ravel()  # flags after a token's first character, taken together
        rest = np.bitwise_or.reduceat(flags, spans)[::2]
        kind[(end - start > 1) & ((flags[start] & UPPER) > 0) & ((rest & (UPPER | LOWER)) == LOWER)] = TITLE
    kind[own[start] == DIGIT], kind[own[start] == END] = NUMBER, STOP
    return start, end, kind, value


@functools.cache
def _unit_hashes() -> np.ndarray:
    return np.sort(_chunk(" ".join(sorted(UNITS)))[3])


def tokenise(text: str | None) -> Tokens:
    """Works on the text's code points, in chunks that end at white space."""
    text, parts, at = text or "", [], 0
    while at < len(text):
        to = at + CHUNK
        while to < len(text) and not text[to].isspace():
            to += 1
        start, end, kind, value = _chunk(text[at:to])
        parts.append((start + at, end + at, kind, value))
        at = to
    if not parts:
        parts = [_chunk("")]
    start, end, kind, value = parts[0] if len(parts) == 1 else map(np.concatenate, zip(*parts, strict=True))
    after = np.flatnonzero(kind[:-1] == NUMBER) + 1  # only there a unit word is one
    units = _unit_hashes()
    unit = units[np.minimum(np.searchsorted(units, value[after]), len(units) - 1)] == value[after]
    kind[after[unit & (kind[after] != STOP) & (kind[after] != NUMBER)]] = UNIT
    return Tokens(text, start, end, kind, value)


class Form(NamedTuple):
    """Tokens of a text in one form: hashes, slot mask, the first and end raw token
    of each, the number of its first word (and of all words, last)."""

    hashes: np.ndarray
    slots: np.ndarray
    keep: np.ndarray
    end: np.ndarray
    word: np.ndarray


def template(text: str | None) -> tuple[Tokens, Form, Form, np.ndarray]:
    """The tokens, the form with all placeholders, the plain form, and the plain
    form's hashes with numbers as they stand."""
    raw = tokenise(text)
    kind, value = raw.kind, raw.value.copy()
    before = np.concatenate(([STOP], kind[:-1])).astype(np.int8) if len(kind) else kind
    number, unit = kind == NUMBER, (kind == UNIT) & (before == NUMBER)
    # a name goes on through capitalised words; its first one is not at a sentence's start
    name = (kind == TITLE) & (before != STOP)
    more = name & (np.concatenate(([False], name[:-1])) if len(name) else name)
    words = np.flatnonzero(kind != STOP)
    literal = value[words]
    value[number] = NUMBER_HASH
    plain = Form(value[words], number[words], words, words + 1, np.arange(len(words) + 1))
    value[unit], value[name] = UNIT_HASH, NAME_HASH
    first = np.flatnonzero(~more[words])
    keep = words[first]
    end = np.concatenate((keep[1:], [len(kind)])).astype(np.int64) if len(keep) else keep
    full = Form(value[keep], (number | unit | name)[keep], keep, end, np.concatenate((first, [len(words)])))
    return raw, full, plain, literal


def as_name(raw: Tokens, form: Form, width: int) -> Form | None:
    """The first window's tokens of an item with its capitalised first word as the
    name that it is after other words; None where it is none or joins the next."""
    if len(form.slots) == 0 or form.slots[0]:
        return None
    at = int(form.keep[0])
    if raw.kind[at] != TITLE or (at + 1 < len(raw.kind) and raw.kind[at + 1] == TITLE):
        return None
    hashes, slots = form.hashes[:width].copy(), form.slots[:width].copy()
    hashes[0], slots[0] = NAME_HASH, True
    return form._replace(hashes=hashes, slots=slots)


def _rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """Polynomial of each ``width`` consecutive hashes."""
    if width == 1:
        return hashes
    part = width // 2 if width % 2 == 0 else width - 1
    n, left = len(hashes) - width + 1, _rolled(hashes, part)
    right = left[part:part + n] if width % 2 == 0 else hashes[part:]
    return left[:n] * np.uint64(pow(0x9E3779B97F4A7C15, width - part, 1 << 64)) + right


def windows(hashes: np.ndarray, slots: np.ndarray, width: int, form: int = FULL,
            literal: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the windows of so many tokens that have enough literals;
    with ``literal`` the others, and all windows of fewer than SHORTEST tokens, have the
    hash of these values."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    enough = None  # every window has: the whole text has few slots
    if 2 * np.count_nonzero(slots) > width:
        filled = np.concatenate(([0], np.cumsum(slots)))
        enough = 2 * (filled[width:] - filled[:-width]) <= width
    with np.errstate(over="ignore"):
        h = _rolled(hashes, width) + np.uint64(form << 8 | width) * np.uint64(FACTOR)
        if literal is None:
            if enough is None:
                return np.arange(n), h
            starts = np.flatnonzero(enough)
            return starts, h[starts]
        if width < SHORTEST:
            h = _rolled(literal, width) + np.uint64(LITERALS << 8 | width) * np.uint64(FACTOR)
        elif enough is not None and not enough.all():
            h = np.where(enough, h, _rolled(literal, width) + np.uint64(LITERALS << 8 | width) * np.uint64(FACTOR))
        return np.arange(n), h


def _slot_values(raw: Tokens, form: Form, start: int, width: int) -> list[str]:
    """Lower-cased values of the slots of a window, empty for literals."""
    return [" ".join(raw.words(form.keep[k], form.end[k])).lower() if form.slots[k] else "" for k in range(start, start + width)]


def _own_widths(form: int, tokens: int) -> list[int]:
    """Widths of the windows of a benchmark item."""
    if tokens >= SHORTEST:
        return [min(tokens, WINDOW)]
    return [tokens] if form == PLAIN and tokens else []


def _groups(texts: list[str | None], alone: bool) -> Iterator[tuple[list[int], str]]:
    """Numbers of consecutive texts and the texts with line feeds between: a line feed ends a
    word, a number and a sentence like a text's end does, so each has the tokens it has alone."""
    group, size = [], 0
    for k, text in enumerate(texts):
        n = len(text or "")
        if group and (alone or size + n > GROUP):
            yield group, "\n".join(texts[i] or "" for i in group)
            group, size = [], 0
        group.append(k)
        size += n + 1
    if group:
        yield group, "\n".join(texts[i] or "" for i in group)


def _scan(df: DataFrame, names: list[str], widths: dict[int, list[int]] | None, bitmap) -> DataFrame:
    """Windows of the texts in ``__text``: the named columns, n_words, form, width, at,
    first and end word, hash, slots.  ``widths`` by form; None: of each text WINDOW or
    its own length, and the windows of ``as_name`` with ``=`` before the fixed value."""
    python_workers(df.sparkSession)
    fields = [f for f in df.schema.fields if f.name in names]
    made = "n_words int, form int, width int, at int, first int, end int, hash long, slots array<string>"
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bitmap is None else np.frombuffer(bitmap.value, dtype=np.uint64).reshape(2, -1)
        one, low, six, there = np.uint64(1), np.uint64(63), np.uint64(6), None
        if bits is not None:
            size = width_of(bits[0])
            shift, second, last = np.uint64(64 - size), np.uint64(64 - 2 * size), np.uint64((1 << size) - 1)
            if bits.shape[1] <= BYTES_FROM_WORDS:  # a byte for each bit: one look-up
                there = np.unpackbits(bits[0].astype("<u8").view(np.uint8), bitorder="little").view(bool)
        for batch in batches:
            rows, cols = [], ([], [], [], [], [], [], [], [])

            def put(ks, ends, raw, form, number, width, starts, h, fixed=False):
                """Windows of the texts ``ks``, whose tokens end at ``ends`` (the first is 0)."""
                of = np.searchsorted(ends, starts, side="right") - 1
                for i, start, x in zip(of.tolist(), starts.tolist(), h.view(np.int64).tolist(), strict=True):
                    first, after = int(ends[i]), int(ends[i + 1])
                    dense = width < SHORTEST or 2 * int(form.slots[start:start + width].sum()) > width
                    slots = [""] * width if dense else _slot_values(raw, form, start, width)
                    if fixed:
                        slots[0] = "=" + slots[0]
                    rows.append(ks[i])
                    word = int(form.word[first])
                    values = (int(form.word[after]) - word, number, width, start - first, int(form.word[start]) - word,
                              int(form.word[start + width]) - word, x, slots)
                    for col, v in zip(cols, values, strict=True):
                        col.append(v)

            texts = batch.column("__text").to_pylist()
            for ks, joined in _groups(texts, widths is None):
                raw, full, plain, literal = template(joined)
                # each text's end, its line feed included, in the joined text
                tail = np.cumsum([len(texts[k] or "") + 1 for k in ks])
                for number, form, values in ((FULL, full, None), (PLAIN, plain, literal)):
                    ends = np.concatenate(([0], np.searchsorted(raw.start[form.keep], tail)))
                    count = np.diff(ends)
                    own = _own_widths(number, len(form.hashes)) if widths is None else [
                        w for w in widths[number] if w > WHOLE or (count == w).any()]
                    for width in own:
                        starts, h = windows(form.hashes, form.slots, width, number, values)
                        if bits is not None:
                            top = h >> shift
                            hit = np.flatnonzero(there[top] if there is not None else bits[0][top >> six] >> (top & low) & one)
                            top = h[hit] >> second & last
                            hit = hit[(bits[1][top >> six] >> (top & low) & one) > 0]
                            of = np.searchsorted(ends, starts[hit], side="right") - 1  # inside one text
                            hit = hit[(starts[hit] + width <= ends[of + 1]) & ((width > WHOLE) | (count[of] == width))]
                            if not len(hit):
                                continue
                            starts, h = starts[hit], h[hit]
                        put(ks, ends, raw, form, number, width, starts, h)
                        if widths is None and number == FULL and width >= SHORTEST and (again := as_name(raw, form, width)) is not None:
                            put(ks, ends, raw, again, number, width, *windows(again.hashes, again.slots, width), fixed=True)
            took = batch.select([f.name for f in fields]).take(pa.array(rows, pa.int64()))
            kinds = (*[pa.int32()] * 6, pa.int64(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*took.columns, *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))],
                names=[*(f.name for f in fields), "n_words", "form", "width", "at", "first", "end", "hash", "slots"])

    return df.select(*(f.name for f in fields), "__text").mapInArrow(run, schema)


def width_of(bits: np.ndarray) -> int:
    """Leading bits of a hash that a bitmap of 64-bit words is addressed by."""
    return (64 * len(bits)).bit_length() - 1


def _bitmap(items: DataFrame, n: int) -> bytes:
    """Two bitmaps, by the leading bits of the windows' hashes and by the bits after these,
    with about eight places for each window, put together in tasks; the driver gets the words
    that are not zero."""
    size = min(max(BITMAP_BITS[0], (8 * n).bit_length()), BITMAP_BITS[1])
    top = F.shiftrightunsigned("hash", 64 - size)
    then = F.shiftrightunsigned("hash", 64 - 2 * size).bitwiseAND(F.lit((1 << size) - 1).cast("long"))
    places = items.select(F.explode(F.array(top, then + F.lit(1 << size).cast("long"))).alias("place"))
    word = F.shiftrightunsigned("place", 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63).cast("long")).cast("int"))
    found = places.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(2 << size - 6, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.tobytes()


def _evidence(items: DataFrame, least: int, shared: int | None) -> DataFrame:
    """The windows that are evidence for an item, and how many of its words are needed:
    all windows, where ``shared`` is None.  Else one that stands in more than so many items is none, so a wording that many items
    share contaminates nothing; ``needed`` counts words of the item's own windows.  Items
    without a window of their own (many equal items) are found through one of them, the least."""
    window = ["form", "width", "hash"]
    many = (items.groupBy(*window).agg(F.count_distinct("item_key", F.coalesce(F.col("item").cast("string"), F.lit("")),
                                                        F.col("item").isNull()).alias("n_items"))
            .where(F.col("n_items") > shared).select(*window)) if shared is not None else None
    marked = (items.withColumn("shared", F.lit(False)) if many is None else
              items.join(many.withColumn("shared", F.lit(True)), window, "left").withColumn("shared", F.coalesce("shared", F.lit(False))))
    key = ["item", "item_key"]
    own = (marked.where("NOT shared").select(*key, F.explode(F.sequence(F.col("first"), F.col("end") - 1)).alias("place"))
           .groupBy(*key).agg(F.count_distinct("place").alias("n_own")))
    same = [F.col(f"w.{k}").eqNullSafe(F.col(f"o.{k}")) for k in key]
    judged = marked.alias("w").join(own.alias("o"), same, "left").select("w.*", F.coalesce("n_own", F.lit(0)).alias("n_own"))
    whole = judged.where("n_own > 0 AND NOT shared").withColumn("needed", F.least(F.lit(least), F.col("n_own")))
    if many is None:
        return whole  # each item has a window of its own
    alone = judged.where("n_own = 0").groupBy(*window).agg(F.min(F.struct("item", "item_key")).alias("one"))
    left = (judged.where("n_own = 0").join(alone, window).where(F.struct("item", "item_key").eqNullSafe(F.col("one")))
            .withColumn("needed", F.least(F.lit(least), F.col("n_words"))).drop("one"))
    return whole.unionByName(left.select(*judged.columns, "needed"))


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text", least: int = LEAST, shared: int | None = SHARED) -> DataFrame:
    """One row for each contaminated document and item: id, item, t1, t2 (name
    of the text), n_matched and n_item (words), exchanged (a slot has another value).
    ``shared``: windows of more items are no evidence; None: all windows are."""
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item_col).alias("item"), F.xxhash64(item_text).alias("item_key"), F.col(item_text).alias("__text"))
    members = bench.select("item", "item_key").distinct()
    if shared is None:  # items of equal text are one until the end
        bench = bench.groupBy("__text", "item_key").agg(F.min("item").alias("item")).select(*bench.columns)
    items = stage(_scan(bench, ["item", "item_key"], None, None), "items")
    n = items.count()
    found_widths = items.select("form", "width").distinct().collect()  # at most WINDOW values for each form
    widths = {form: sorted(r.width for r in found_widths if r.form == form) for form in (FULL, PLAIN)}
    bitmap = spark.sparkContext.broadcast(_bitmap(items, n))
    given = docs.select(F.col(id_col).alias("id"), *text_key(F.col(text_col)), F.col(text_col).alias("__text"))
    found = _scan(given, ["id", "t1", "t2"], widths, bitmap).drop("n_words", "first", "end")
    known = _evidence(items, least, shared).select(
        "item", "item_key", "form", "width", "hash", F.col("n_words").alias("n_item"), "needed", "first", "end",
        F.col("at").alias("item_at"), F.col("slots").alias("item_slots"))
    joined = found.join(F.broadcast(known) if n <= BROADCAST_WINDOWS else known, ["hash", "form", "width"])
    both = F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    # a fixed value (=) stands in the document too, at the end of the name
    stands = F.forall(both, lambda x: ~F.startswith(x["a"], F.lit("=")) | F.endswith(
        F.concat(F.lit(" "), x["b"]), F.concat(F.lit(" "), F.substr(x["a"], F.lit(2)))))
    pairs = F.filter(both, lambda x: (x["a"] != "") & ~F.startswith(x["a"], F.lit("=")))
    key = ["id", "t1", "t2", "item", "item_key", "n_item", "needed"]
    diagonals = (joined.where(stands)
                 .select(*key, "form", "first", "end", (F.col("at") - F.col("item_at")).alias("diagonal"), pairs.alias("pairs"))
                 .groupBy(*key, "form", "diagonal").agg(F.collect_set(F.struct("first", "end", "pairs")).alias("found")))
    # an item's values that stand for several values of the document on the diagonal
    values = F.array_sort(F.array_distinct(F.flatten(F.col("found.pairs"))))
    several = let(values, lambda ps: F.filter(F.transform(ps, lambda p, i: F.when(
        F.get(ps, i + 1)["a"] == p["a"], p["a"])), lambda a: a.isNotNull()))
    kept = let(several, lambda no: F.filter("found", lambda w: F.forall(
        w["pairs"], lambda p: (p["a"] == p["b"]) | ~F.array_contains(no, p["a"]))))
    places = F.array_distinct(F.flatten(F.transform("kept", lambda w: F.sequence(w["first"], w["end"] - 1))))
    result = (diagonals.select(*key, kept.alias("kept"), "found").where(F.size("kept") > 0)
            .select(*key, places.alias("places"), F.exists(F.flatten("found.pairs"), lambda x: x["a"] != x["b"]).alias("other"))
            .groupBy(*key).agg(F.size(F.array_distinct(F.flatten(F.collect_set("places")))).cast("long").alias("n_matched"),
                               F.max("other").alias("exchanged"))
            .where("n_matched >= needed"))
    if shared is None:
        result = result.drop("item").join(members, "item_key")
    return (result
            .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "t1", "t2", "n_matched",
                    F.col("n_item").cast("long").alias("n_item"), "exchanged"))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **names) -> DataFrame:
    """The rows of ``docs`` whose text no item contaminates, with all their columns; every
    window of an item is evidence unless ``shared`` is given."""
    a, b = fresh(docs, "__t1"), fresh(docs, "__t2")
    names.setdefault("shared", None)
    id_col = names.pop("id_col", "doc_id")
    bad = stage(matches(docs, benchmark, id_col, text_col, **names).select("t1", "t2").distinct(), "contaminated")
    t1, t2 = text_key(F.col(text_col))
    marked = docs.withColumn(a, t1).withColumn(b, t2)
    return (marked.join(bad.withColumnsRenamed({"t1": a, "t2": b}), [a, b], "left_anti").select(*docs.columns))
