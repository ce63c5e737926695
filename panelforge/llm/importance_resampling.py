"""Resampling of documents towards a target distribution, by hashed word runs.

Features are all runs of 1 to 3 consecutive words, dealt into ``BUCKETS`` buckets by their CRC-32.  No run is ever put
together as a string.  Every worker keeps an Aho-Corasick automaton over the distinct words that it has met, each bounded by a
delimiter on both sides, with the word's CRC and length as payload.  A scan of a text emits the payloads of its words in
order, and the payloads of neighbours are composed: the CRC of ``a b`` is that of ``a``, advanced by as many zero bytes as
`` b`` has (a linear map, looked up byte by byte), exclusive-or that of `` b``.  Words that the automaton lacks leave a gap in
the scan; they are hashed by themselves and join the dictionary, and the automaton is rebuilt whenever the dictionary has
doubled.  Beyond ``MAX_WORDS`` words a worker hashes further new words each time, so results never depend on the dictionary.

Documents and target are scanned once for the bucket counts, added up per task and then over all tasks, and the documents once more for their
scores.  A bucket's gain and the seeded noise are logarithms rounded down.  Ranks come from one distributed sort.

Defined results: NULL and wordless texts have no features and weight 0; very long texts are scanned in pieces cut between
words; equal scores go by the smaller id, rows without an id last, then fewer features; the noise of a row without an id is that of the id
``null``; repeated rows are rows of their own; an empty documents table gives an empty table, an empty target makes every bucket
equally unwanted; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import CAPITALS, PLAIN_PATTERN, SMALL, bounded_batches, fresh, identified, plain
from panelforge.operators.quantiles import number_rows
from panelforge.storage import materialize

BUCKETS = 10_000
SEED = "42"
MIN_WORDS = 20
DRAW_PERCENT = 5

#: Words in a worker's automaton, bytes scanned at once, words composed at once.
MAX_WORDS = 1 << 16
PIECE_BYTES = 1 << 20
STEP_WORDS = 1 << 18

_SPACE = 32


def _byte_table() -> np.ndarray:
    """The register of CRC-32 (reflected polynomial 0xEDB88320) after each byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


def _apply(row: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given as its values at each byte of each place."""
    return row[0, x & 255] ^ row[1, (x >> 8) & 255] ^ row[2, (x >> 16) & 255] ^ row[3, x >> 24]


class Advance:
    """Maps that advance a CRC by a number of zero bytes; one row of ``table`` per length asked for."""

    def __init__(self) -> None:
        self.unit = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
        one = (self.unit >> 8) ^ _byte_table()[self.unit & 255]
        self.powers = [one]
        self.rows: dict[int, int] = {}
        self.table = np.zeros((64, 4, 256), np.uint32)

    def row(self, n_bytes: int) -> int:
        if n_bytes not in self.rows:
            made, bit = self.unit, 0
            while n_bytes >> bit:
                if bit == len(self.powers):
                    self.powers.append(_apply(self.powers[-1], self.powers[-1]))
                if n_bytes >> bit & 1:
                    made = _apply(self.powers[bit], made)
                bit += 1
            at = len(self.rows)
            if at == len(self.table):
                self.table = np.concatenate((self.table, np.zeros_like(self.table)))
            self.table[at] = made
            self.rows[n_bytes] = at
        return self.rows[n_bytes]

    def __call__(self, crcs: np.ndarray, rows: np.ndarray) -> np.ndarray:
        t = self.table
        return t[rows, 0, crcs & 255] ^ t[rows, 1, (crcs >> 8) & 255] ^ t[rows, 2, (crcs >> 16) & 255] ^ t[rows, 3, crcs >> 24]


class WordDictionary:
    """Distinct words with their payloads, in an automaton that emits them."""

    def __init__(self, limit: int = MAX_WORDS) -> None:
        self.limit = limit
        self.codes: dict[bytes, int] = {}
        self.passing: dict[bytes, int] = {}
        self.advance = Advance()
        self.alone, self.spaced = np.zeros(1024, np.uint32), np.zeros(1024, np.uint32)
        self.rows = np.zeros(1024, np.int32)
        self.automaton, self.known = None, 0

    def _enter(self, word: bytes) -> int:
        code = len(self.codes) + len(self.passing)
        if code == len(self.rows):
            self.alone, self.spaced, self.rows = (np.concatenate((x, np.zeros_like(x))) for x in (self.alone, self.spaced, self.rows))
        self.alone[code], self.spaced[code], self.rows[code] = crc32(word), crc32(b" " + word), self.advance.row(len(word) + 1)
        (self.codes if code < self.limit else self.passing)[word] = code
        return code

    def _rebuild(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for word, code in self.codes.items():
            self.automaton.add_word(f" {word.decode('latin-1')} ", code)
        self.automaton.make_automaton()
        self.known = len(self.codes)

    def scan(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Code and start of every word of ``data``, plain text with a space at either end.  Codes hold until the next scan."""
        self.passing.clear()
        grown = len(self.codes)
        if grown > max(1024, 2 * self.known) or self.known < grown == self.limit:
            self._rebuild()
        inside = (np.frombuffer(data, np.uint8) != _SPACE).view(np.int8)
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1) + 1, np.flatnonzero(edges == -1) + 1
        codes = np.full(len(starts), -1, np.int32)
        if self.automaton is not None:
            emitted = np.fromiter(chain.from_iterable(self.automaton.iter(data.decode("latin-1"))), np.int64).reshape(-1, 2)
            codes[np.searchsorted(ends, emitted[:, 0])] = emitted[:, 1]
        for i in np.flatnonzero(codes < 0).tolist():
            word = data[starts[i] : ends[i]]
            code = self.codes.get(word)
            if code is None:
                code = self.passing.get(word)
            codes[i] = self._enter(word) if code is None else code
        return codes, starts

    def payloads(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """CRC, CRC behind a space, and row of the advancing map."""
        return self.alone[codes], self.spaced[codes], self.rows[codes]


_worker: list[WordDictionary] = []


def dictionary() -> WordDictionary:
    """The dictionary of this worker process."""
    if not _worker:
        _worker.append(WordDictionary())
    return _worker[0]


def _pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """A padded plain text cut between words, each piece with a space at either end."""
    at, end = 0, len(data)
    while at < end - 1:
        stop = end if end - at <= size else data.rfind(b" ", at + 1, at + size) + 1 or data.find(b" ", at + size) + 1
        yield data[at:stop]
        at = stop - 1


Payloads = tuple[np.ndarray, np.ndarray, np.ndarray]


def _buckets(payloads: Payloads, owner: np.ndarray, words: WordDictionary, upto: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and owner of every run of 1 to 3 words that begins before place ``upto`` and has one owner."""
    alone, spaced, rows = payloads
    run = alone
    for more in range(3):
        if more:
            run = words.advance(run[:-1], rows[more:]) ^ spaced[more:]
        one = owner[: len(run)] == owner[more:]
        one[upto:] = False
        yield (run[one] % np.uint32(BUCKETS)).astype(np.int64), owner[: len(run)][one]


def feature_buckets(texts: list[bytes | None], words: WordDictionary) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets of features, the number of their text in ``texts``, and words of each text, by parts of bounded size."""

    def part(payloads: list[Payloads], owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        whole = tuple(np.concatenate(c) for c in zip(*payloads, strict=True))
        for at in range(0, len(owner), STEP_WORDS):
            stop = at + STEP_WORDS
            cut = tuple(c[at : stop + 2] for c in whole)
            made = list(_buckets(cut, owner[at : stop + 2], words, STEP_WORDS))
            yield np.concatenate([b for b, _ in made]), np.concatenate([o for _, o in made]), np.bincount(owner[at:stop], minlength=len(texts))

    group, numbers, held = [], [], 0

    def flush() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        if group:
            codes, starts = words.scan(b" " + b" ".join(group) + b" ")
            firsts = np.cumsum([0, *(len(t) + 1 for t in group[:-1])]) + 1
            owner = np.array(numbers)[np.searchsorted(firsts, starts, "right") - 1]
            yield from part([words.payloads(codes)], owner)

    for number, text in enumerate(texts):
        if text and len(text) > PIECE_BYTES:
            found = [words.payloads(words.scan(p)[0]) for p in _pieces(b" " + plain(text) + b" ")]
            yield from part(found, np.full(sum(len(f[0]) for f in found), number))
        elif text:
            if held + len(text) > PIECE_BYTES:
                yield from flush()
                group, numbers, held = [], [], 0
            group.append(plain(text))
            numbers.append(number)
            held += len(text)
    yield from flush()


def bucket_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """Features per bucket over a whole table: one row per bucket that has any."""
    bounded_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = dictionary(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for buckets, _, _ in feature_buckets(batch.column(0).cast(pa.binary()).to_pylist(), words):
                total += np.bincount(buckets, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    found = texts.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text") -> np.ndarray:
    """The gain of every bucket, ``BUCKETS`` whole numbers."""
    both = bucket_counts(docs, text_col).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
    both = both.union(bucket_counts(target, target_col).select("bucket", F.lit(0).cast("long"), "n"))
    counts = np.zeros((BUCKETS, 2), np.int64)
    for row in both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect():
        counts[row["bucket"]] = row["s"], row["t"]
    s, t = (counts[:, k].astype(np.float64) for k in (0, 1))
    ratio = ((t + 1) * (s.sum() + BUCKETS)) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: words, features and the sum of its features' gains."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = dictionary()
        for batch in batches:
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            n = len(texts)
            made = np.zeros((3, n), np.int64)
            for buckets, owner, n_words in feature_buckets(texts, words):
                made[0] += n_words
                made[1] += np.bincount(owner, minlength=n)
                # sums of whole numbers below 2**53 are exact in doubles
                made[2] += np.bincount(owner, gain[buckets], n).astype(np.int64)
            columns = [*batch.columns[1:], *map(pa.array, made)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[1:], "n_words", "n_features", "weight"])

    narrow = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), *carry)
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema.fields[1:])
    return narrow.mapInArrow(run, f"{kept}, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = DRAW_PERCENT,
    min_words: int = MIN_WORDS,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: features, weight, score, and rank among the drawn (NULL for the others)."""
    weighed = weights(docs, gains(docs, target, text_col, target_col), id_col, text_col, carry)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    scored = weighed.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(share))))
    scored = materialize(scored, "importance")
    fit = scored.where(F.col("n_words") >= min_words)
    drawn = percent * fit.count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc()]
    place = F.col("__place") + 1
    ranked = number_rows(fit, [], order).withColumn("rank", F.when(place <= drawn, place))
    short = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank", *carry]
    return ranked.select(*columns).unionByName(short.select(*columns))


def drawn_documents(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn rows of ``docs``, with their rank (underscores before it where ``docs`` has such a column)."""
    marked, row = identified(docs)
    rows = marked.withColumnRenamed(row, "__row") if row != "__row" else marked
    drawn = resample(rows, target, carry=("__row",), **settings).where(F.col("rank").isNotNull())
    drawn = drawn.select("__row", F.col("rank").alias(fresh(docs, "rank")))
    return rows.join(drawn, "__row").drop("__row")


def sql(percent: int = DRAW_PERCENT, min_words: int = MIN_WORDS, seed: str = SEED) -> str:
    """DuckDB text for ``resample`` of ``documents`` towards ``benchmark``; every distinct run is put together and hashed byte by byte."""
    runs = "".join(
        f" UNION ALL SELECT part, row, unnest(list_transform(range(1, len(w) - {k - 1}), lambda i: array_to_string(w[i:i + {k}], ' '))) AS f FROM words"
        for k in (1, 2)
    )
    return f"""
WITH steps AS (
  SELECT list(v ORDER BY n) AS t FROM (
    SELECT n, list_reduce([n, 1, 1, 1, 1, 1, 1, 1, 1], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(generate_series(0, 255))::BIGINT AS n))),
texts AS (
  SELECT 's' AS part, row_number() OVER () AS row, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark),
words AS (
  SELECT part, row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '{PLAIN_PATTERN}') AS w FROM texts),
runs AS (SELECT part, row, unnest(w) AS f FROM words{runs}),
held AS (SELECT part, row, f, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
  SELECT f, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode(f)), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT f FROM held), steps),
counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (part = 's'), 0) AS s, coalesce(sum(n) FILTER (part = 't'), 0) AS t FROM held JOIN hashed USING (f) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS ss, coalesce(sum(t), 0)::DOUBLE AS tt FROM counts),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (ss + {BUCKETS})) / ((s + 1)::DOUBLE * (tt + {BUCKETS}))))::BIGINT AS gain FROM counts, totals),
weighed AS (
  SELECT row, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM held JOIN hashed USING (f) JOIN gains USING (bucket) WHERE part = 's' GROUP BY row),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM words LEFT JOIN weighed USING (row) WHERE part = 's'),
ranked AS (
  SELECT *, CASE WHEN n_words >= {min_words} THEN row_number() OVER (PARTITION BY n_words >= {min_words} ORDER BY score DESC, doc_id NULLS LAST, n_features) END AS place,
    (count(*) FILTER (n_words >= {min_words}) OVER ()) * {percent} // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM ranked
"""
