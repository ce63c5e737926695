"""Benchmark decontamination by template windows and slot consistency.

Texts become templates: numbers, names (capitalised words
within a sentence, unless all in capitals; neighbouring ones are one name) and units
after numbers are replaced by typed placeholders, other words are lower-cased and stripped of punctuation.  Windows of
``WINDOW`` template words of every item are hashed; the windows of every document are joined to them by hash.  Matches of
an item on one alignment give a mapping from the item's slot values to the document's.  It must be one to one, so that a
question asked again with other numbers and names is caught and a form that merely looks alike is not; windows that hold a
conflicting slot do not count.  A document leaks an item when the others cover ``MIN_CONTAINMENT`` of the item's windows.
With ``plain_names`` a second template leaves names as lower-cased words, so that copies in other letters are caught; either
may match.

Items are cut into windows on the executors and stay a table.  A bit map of their hashes, sized by their number up to
2**``MAX_BITS`` bits, goes with the tasks that read documents, so that hardly a window without a partner leaves its task; the rest
meet in a hash join, for which the items' windows are broadcast only where counting them found at most ``BROADCAST_WINDOWS``.
Slot values travel as 64-bit hashes.  Matches are dealt by document and item and gathered by alignment, which holds every window
of the item once at most.  After a sum has dropped the pairs that cannot reach the threshold, the alignments of a pair stream
through its judgement, longest first: it keeps one mapping and the windows covered, both bounded by the item, so a document
that repeats an item's lines any number of times is never gathered.

Defined results: items with fewer than ``MIN_WORDS`` template words, NULL ones and items made of slots only included, match
nothing; very long texts are read whole, in batches of bounded bytes; of alignments of one length the first in the text comes first; NULL and empty
documents leak nothing; repeated items and documents are each reported; empty tables give no pairs; extra columns are
ignored, or passed through by ``without_leaks``.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import bounded_batches, identified
from panelforge.storage import materialize

WINDOW = 8
MIN_WORDS = 4
MIN_CONTAINMENT = 0.5

#: Windows of items that may be broadcast, some 100 bytes each.
BROADCAST_WINDOWS = 200_000

#: Units that make a placeholder after a number.
UNITS = frozenset(
    "mg g kg t lb lbs oz mm cm m km in inch inches ft feet mi mile miles ml l liter liters s sec second seconds min minute minutes "
    "h hr hour hours day days week weeks month months year years percent cent cents dollar dollars euro euros usd eur kmh mph".split()
)

_NUMBER, _CAPITAL, _SENTENCE, _LINE, _EMPTY, _UNIT = 1, 2, 4, 8, 16, 32
_EDGES = string.punctuation + "“”„«»‹›‘’…–—¿¡"
_DIGITS = re.compile(r"[+-]?[\d][\d.,:/^x*+-]*[a-z%]{0,3}$")
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX, _ALL = 0xD6E8FEB86659FD93, (1 << 64) - 1
_CACHE = 300_000
_FLUSH = 50_000

#: Powers of two: the bits of the map of item windows, at least and at most (16 MiB; fuller beyond, then more windows are shuffled).
MIN_BITS, MAX_BITS = 24, 27

#: Bits of the map for each item window.
BITS_PER_WINDOW = 16


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text, 7)


_PLACEHOLDER = {kind: np.uint64(_hash(f"<{kind}>")) for kind in ("number", "name", "unit")}


class Templates(dict):
    """Memo of words to their hash and kind; emptied between texts when full."""

    def __init__(self) -> None:
        super().__init__()
        self._clear()

    def _clear(self) -> None:
        self.clear()
        self.hashes = np.zeros(1024, np.uint64)
        self.flags = np.zeros(1024, np.uint8)

    def __missing__(self, word: bytes) -> int:
        code = len(self)
        if code >= len(self.hashes):
            self.hashes, self.flags = (np.concatenate((x, np.zeros_like(x))) for x in (self.hashes, self.flags))
        if word == b"\0":
            self.flags[code] = _LINE
        else:
            text = word.decode("utf-8", "replace")
            core = text.strip(_EDGES)
            low = core.lower()
            flag = 0 if core else _EMPTY
            if _DIGITS.match(low):
                flag |= _NUMBER
            elif core[:1].isupper() and not core.isupper():
                flag |= _CAPITAL
            if low in UNITS:
                flag |= _UNIT
            if text.rstrip("\"'”’)»")[-1:] in (".", "!", "?", ":"):
                flag |= _SENTENCE
            self.flags[code], self.hashes[code] = flag, _hash(low)
        self[word] = code
        return code

    def template(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """Hashes of the template words, whether each is a placeholder, the words of the text, and where each begins in them."""
        return self.templates(text, False)[0]

    def templates(self, text: bytes | None, plain_names: bool) -> list[tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]]:
        """The template, and with ``plain_names`` the one that leaves names as lower-cased words."""
        if len(self) > _CACHE:
            self._clear()
        words = (text or b"").replace(b"\n", b" \0 ").split()
        codes = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        flags = self.flags[codes]
        before = np.concatenate((np.array([_LINE], np.uint8), flags[:-1]))[: len(flags)]
        kept = np.nonzero((flags & (_LINE | _EMPTY)) == 0)[0]
        flags, inner = flags[kept], (before[kept] & (_SENTENCE | _LINE)) == 0
        number = (flags & _NUMBER) > 0
        name = ((flags & _CAPITAL) > 0) & inner
        unit = ((flags & _UNIT) > 0) & np.concatenate(([False], number[:-1]))[: len(number)]
        plain = self.hashes[codes[kept]]
        h = plain.copy()
        h[name] = _PLACEHOLDER["name"]
        for kind, where in (("unit", unit), ("number", number)):
            h[where] = plain[where] = _PLACEHOLDER[kind]
        again = name & np.concatenate(([False], name[:-1]))[: len(name)]
        single = ~again
        typed = (h[single], (number | name | unit)[single], words, kept[single])
        return [typed, (plain, number | unit, words, kept)] if plain_names else [typed]


def windows(h: np.ndarray, length: int) -> np.ndarray:
    n = len(h) - length + 1
    out = np.zeros(max(0, n), np.uint64)
    for j in range(length if n > 0 else 0):
        out = out * _PRIME + h[j : j + n]
    return out


def keyed_windows(h: np.ndarray, length: int, kind: int) -> np.ndarray:
    """Hashes of the windows that differ by length and kind of template as well."""
    return windows(h, length) + np.uint64((length + kind * 2 * WINDOW) * _MIX & _ALL)


def _values(words: list[bytes], at: np.ndarray, h: np.ndarray, slots: np.ndarray, memo: dict[int, int], begin: int, length: int) -> tuple[list[int], list[int]]:
    """Slots of a window: their places in it, and hashes of kind and lower-cased text up to the next template word."""
    places = np.nonzero(slots[begin : begin + length])[0].tolist()
    out = []
    for i in places:
        i += begin
        if i not in memo:
            end = at[i + 1] if i + 1 < len(at) else len(words)
            raw = b" ".join(w for w in words[at[i] : end] if w != b"\0").decode("utf-8", "replace")
            memo[i] = xxhash.xxh64_intdigest(raw.strip(_EDGES).lower().encode(), int(h[i])) >> 1
        out.append(memo[i])
    return places, out


def _item_windows(plain_names: bool):
    """Windows of the items, for both kinds of template."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Templates()
        for batch in batches:
            rows: list[tuple] = []
            for item, item_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for kind, (h, slots, words, at) in enumerate(memo.templates(text.encode(), plain_names)):
                    length = min(WINDOW, len(h))
                    if length < MIN_WORDS or slots.all():
                        continue
                    found = keyed_windows(h, length, kind).view(np.int64).tolist()
                    seen: dict[int, int] = {}
                    for there, key in enumerate(found):
                        rows.append((key, item, item_id, kind, len(found), length, there, _values(words, at, h, slots, seen, there, length)[1]))
                if len(rows) > _FLUSH:
                    yield _batch(rows, _ITEM_FIELDS)
                    rows = []
            if rows:
                yield _batch(rows, _ITEM_FIELDS)

    return run


_ITEM_FIELDS = [("key", pa.int64()), ("item", pa.int64()), ("item_id", pa.int64()), ("kind", pa.int32()), ("size", pa.int64()), ("length", pa.int32()), ("there", pa.int32()), ("theirs", pa.list_(pa.int64()))]
_HIT_FIELDS = [("key", pa.int64()), ("place", pa.int32()), ("at", pa.list_(pa.int32())), ("own", pa.list_(pa.int64()))]


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], names=[n for n, _ in fields])


def item_windows(benchmark: DataFrame, plain_names: bool = False) -> DataFrame:
    """Every window of every item (``item`` tells repeated ones apart) with the values of its slots."""
    bounded_batches(benchmark.sparkSession)
    texts = benchmark.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    schema = "key long, item long, item_id long, kind int, size long, length int, there int, theirs array<long>"
    return materialize(texts.where("text IS NOT NULL").mapInArrow(_item_windows(plain_names), schema), "item-windows")  # fixes the numbers


def _bit_map(known: DataFrame, count: int) -> bytes:
    """The bit map of the hashes, from at most 2**(MAX_BITS - 6) words of 64 bits."""
    bits = min(max(MIN_BITS, (count * BITS_PER_WINDOW).bit_length()), MAX_BITS)
    top = F.shiftrightunsigned("key", 64 - bits)
    cells = known.select(F.shiftright(top, 6).alias("cell"), F.expr(f"shiftleft(1L, cast(key >>> {64 - bits} & 63 AS int))").alias("bit"))
    found = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found["cell"].to_numpy()] = found["bits"].to_numpy()
    return out.tobytes()


def _hits(lengths: list[int], bits: bytes, plain_names: bool):
    """Windows of documents whose bit is set, with the columns in front of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(bits, np.uint8)
        shift = np.uint64(64 - (len(marks) * 8).bit_length() + 1)
        memo = Templates()

        def made(batch: pa.RecordBatch, who: list[int], rows: list[tuple]) -> pa.RecordBatch:
            kept = batch.select(range(batch.num_columns - 1)).take(pa.array(who, pa.int64()))
            found = _batch(rows, _HIT_FIELDS)
            return pa.RecordBatch.from_arrays([*kept.columns, *found.columns], names=[*kept.schema.names, *found.schema.names])

        for batch in batches:
            rows: list[tuple] = []
            who: list[int] = []
            for number, text in enumerate(batch.column(batch.num_columns - 1).cast(pa.binary())):
                for kind, (h, slots, words, at) in enumerate(memo.templates(text.as_py(), plain_names)):
                    seen: dict[int, int] = {}
                    for length in lengths:
                        own = keyed_windows(h, length, kind)
                        bit = own >> shift
                        met = np.flatnonzero(marks[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
                        for place, key in zip(met.tolist(), own[met].view(np.int64).tolist(), strict=True):
                            rows.append((key, place, *_values(words, at, h, slots, seen, place, length)))
                            who.append(number)
                            if len(rows) > _FLUSH:
                                yield made(batch, who, rows)
                                rows, who = [], []
            if rows:
                yield made(batch, who, rows)

    return run


class Coverage:
    """What a document covers of an item of ``size`` windows, under one one-to-one mapping of slots.

    Alignments come longest first.  Only the windows that hold a conflicting slot are dropped from one; equal slots come first,
    then frequent ones.
    """

    def __init__(self, size: int) -> None:
        self.size = size
        self.covered: set[int] = set()
        self.forth: dict[int, int] = {}
        self.back: dict[int, int] = {}
        self.compared = self.changed = 0

    def add(self, group: list[dict]) -> None:
        """Another alignment, as its matches."""
        if len(self.covered) == self.size:
            return
        spots = {m["there"] + i: pair for m in group for i, *pair in zip(m["at"], m["theirs"], m["own"], strict=False)}
        often = Counter(map(tuple, spots.values()))
        to: dict[int, int] = {}
        fro: dict[int, int] = {}
        for a, b in sorted(often, key=lambda x: (x[0] != x[1], -often[x], x)):
            if self.forth.get(a, to.get(a, b)) == b and self.back.get(b, fro.get(b, a)) == a:
                to[a], fro[b] = b, a
        kept = [m for m in group if all(to.get(a) == b for a, b in zip(m["theirs"], m["own"], strict=False))]
        used = [spots[spot] for spot in {m["there"] + i for m in kept for i in m["at"]}]
        self.forth.update(used)
        self.back.update((b, a) for a, b in used)
        self.compared += len(used)
        self.changed += sum(a != b for a, b in used)
        self.covered.update(m["there"] for m in kept)


_PAIR = ["row", "item", "kind"]
_HEAD = ["row", "doc_id", "item", "kind", "item_id", "size"]


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per pair from its alignments, which follow each other, also from batch to batch."""

    def made(ended: list[tuple[pa.RecordBatch, Coverage]]) -> Iterator[pa.RecordBatch]:
        if ended:
            heads = pa.Table.from_batches([head for head, _ in ended]).combine_chunks()
            counts = zip(*((len(c.covered), c.compared, c.changed) for _, c in ended), strict=True)
            for name, values in zip(("n_windows", "n_slots", "n_changed"), counts, strict=True):
                heads = heads.append_column(name, pa.array(values, pa.int64()))
            yield from heads.to_batches()

    pair, last = None, []
    for batch in batches:
        ended = []
        heads, matches = batch.select(_HEAD), batch.column("matches")
        for i, here in enumerate(zip(*(batch.column(c).to_pylist() for c in _PAIR), strict=True)):
            if here != pair:
                ended += last
                pair, last = here, [(heads.slice(i, 1), Coverage(batch.column("size")[i].as_py()))]
            last[0][1].add(matches[i].as_py())
        yield from made(ended)
    yield from made(last)


def _leaks(rows: DataFrame, benchmark: DataFrame, min_containment: float, broadcast_windows: int, plain_names: bool) -> DataFrame:
    """Leaks of ``rows`` (``row``, ``doc_id``, ``text``): one row per document and item, of the kind of template that covers more."""
    known = item_windows(benchmark, plain_names)
    lengths = sorted(r["length"] for r in known.select("length").distinct().collect())  # at most WINDOW - MIN_WORDS + 1
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("row", "doc_id"))
    count = known.count()
    hits = rows.select("row", "doc_id", "text").mapInArrow(_hits(lengths, _bit_map(known, count), plain_names), f"{kinds}, key long, place int, at array<int>, own array<long>")
    met = hits.join(F.broadcast(known) if count <= broadcast_windows else known, "key").withColumn("offset", F.col("place") - F.col("there"))
    facts = [F.first(c).alias(c) for c in ("doc_id", "item_id", "size")]
    # dealt by pair, so neither the alignments nor the sums over a pair move rows again
    aligned = met.repartition(*_PAIR).groupBy(*_PAIR, "offset").agg(*facts, F.collect_list(F.struct("there", "at", "own", "theirs")).alias("matches"))
    aligned = aligned.withColumn("n", F.size("matches"))
    enough = aligned.withColumn("total", F.sum("n").over(Window.partitionBy(*_PAIR))).where(F.col("total") >= F.lit(float(min_containment)) * F.col("size"))
    judged = enough.sortWithinPartitions(*_PAIR, F.col("n").desc(), "offset").select(*_HEAD, "matches").mapInArrow(_judged, f"{kinds}, item long, kind int, item_id long, size long, n_windows long, n_slots long, n_changed long")
    leaks = judged.where(F.col("n_windows") >= F.lit(float(min_containment)) * F.col("size")).withColumn("containment", F.col("n_windows") / F.col("size"))
    if not plain_names:
        return leaks
    best = F.max_by(F.struct("doc_id", "item_id", "containment", "n_windows", "n_slots", "n_changed"), F.struct("containment", -F.col("kind")))
    return leaks.groupBy("row", "item").agg(best.alias("best")).select("row", "best.*")


def _narrow(docs: DataFrame, row: str, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(row).alias("row"), F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def leaked_pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_containment: float = MIN_CONTAINMENT, broadcast_windows: int = BROADCAST_WINDOWS, plain_names: bool = False) -> DataFrame:
    """One row per document and item that it leaks; with ``plain_names`` copies that write names in other letters count too."""
    docs, row = identified(docs)
    found = _leaks(_narrow(docs, row, id_col, text_col), benchmark, min_containment, broadcast_windows, plain_names)
    return found.select("doc_id", "item_id", "containment", "n_windows", "n_slots", "n_changed").withColumn("reparameterised", F.col("n_changed") > 0)


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_containment: float = MIN_CONTAINMENT, broadcast_windows: int = BROADCAST_WINDOWS, plain_names: bool = False) -> DataFrame:
    """``docs`` without the documents that leak an item."""
    docs, row = identified(docs)
    found = _leaks(_narrow(docs, row, id_col, text_col), benchmark, min_containment, broadcast_windows, plain_names)
    leaking = materialize(found.select(F.col("row").alias(row)).distinct(), "leaking")
    return docs.join(leaking, row, "left_anti").drop(row)
