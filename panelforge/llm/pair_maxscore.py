"""Ranked lexical search with bounds from term pairs.

Documents are cut into segments of ``SEGMENT_DOCS``; a segment is one row of the written index and is searched by one task for all items.
It holds, for every term of the items, the list of its documents with their impacts (weight times damped frequency), and
the highest impact in every block of ``BLOCK_DOCS`` documents.  For pairs of terms it also holds the intersection list: the
blocks in which some document has both terms, with the highest joint impact.  Pairs are neighbours of an item's terms
ordered by weight, so every term of an item is in one pair at most.

At query time the bound of a pair in a block is the greater of its joint maximum and the two single maxima, which is never above
their sum; added up over the item's pairs it bounds every document of the block.  Blocks whose bound lies below
the tenth best score so far are skipped.  In the others, pairs are added one after another, and a document is dropped as
soon as its sum and the bounds of the pairs still to come cannot reach that score; once few are left, lists are searched
for them instead of being read.  The best blocks go first, and the tenth best score is carried from segment to segment.
Bounds only decide what to skip: results are those of a complete search.

Documents, counts and lengths cover the whole table.  Items are taken in blocks of a bounded number of terms, one index
each, so neither the driver nor a task holds all of a large item table.  Every task returns the best few of each item, of which the best are taken.

Defined results: NULL and wordless texts count as no documents and match nothing; items without a known term give no row; rows with the same item id are one
item; equal scores go by ascending id, rows without an id last; repeated rows are ranked each; very long texts are read
whole; an empty table on either side gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from panelforge.llm.common import CAPITALS, PLAIN_PATTERN, SMALL, bounded_batches, plain
from panelforge.storage import materialize

TOP = 10
SEGMENT_DOCS = 8192
SEGMENT_POSTINGS = 1 << 20
BLOCK_DOCS = 64
SEED_BLOCKS = 2
BLOCK_TERMS = 200_000

_INDEX = (
    "docs array<long>, terms array<int>, ends array<int>, locals array<int>, impacts array<long>, "
    "pairs array<int>, pair_ends array<int>, pair_blocks array<int>, pair_peaks array<long>"
)


@dataclass
class Items:
    """A block of items: their ids, the code of every term, and each item's terms as codes."""

    ids: list
    codes: dict[bytes, int]
    terms: list[list[int]]


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (``item``, ``term``) rows."""
    text = F.translate(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), CAPITALS, SMALL)
    words = F.regexp_extract_all(text, F.lit(PLAIN_PATTERN), F.lit(0))
    return items.select(F.col(f"`{id_col}`").alias("item"), F.explode(words).alias("term")).distinct()


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", block_terms: int = BLOCK_TERMS) -> Iterator[Items]:
    """Items by hash of their id, some ``block_terms`` terms at a time."""
    rows = materialize(item_terms(items, id_col, text_col), "item-terms")
    parts = math.ceil(rows.count() / block_terms)
    for part in range(parts):
        ids: dict = {}
        codes: dict[bytes, int] = {}
        terms: list[list[int]] = []
        for row in rows.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).toLocalIterator():
            at = ids.setdefault(row["item"], len(ids))
            if at == len(terms):
                terms.append([])
            terms[at].append(codes.setdefault(row["term"].encode(), len(codes)))
        if ids:
            yield Items(list(ids), codes, terms)


def frequencies(docs: DataFrame, codes: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, all its terms counted, and how often it has each known term."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found, counts = [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                words = plain(text).split() if text else []
                held = {codes[w]: n for w, n in Counter(words).items() if w in codes}
                sizes.append(len(words))
                found.append(list(held))
                counts.append(list(held.values()))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "codes", "counts"])

    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n long, codes array<int>, counts array<int>").where("n > 0")


def term_weights(forward: DataFrame, n_docs: int, n_codes: int) -> np.ndarray:
    """The weight of every known term; 0 for those that no document has."""
    weight = np.zeros(n_codes, np.int64)
    for row in forward.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("df")).toLocalIterator():
        weight[row["code"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * row["df"] + 1)))
    return weight


def pair_up(terms: list[list[int]], weight: np.ndarray) -> tuple[list[list[int]], list[tuple[int, int]]]:
    """Every item's pairs, as places in a list of distinct pairs, heaviest first; an odd last term is paired with itself."""
    places: dict[tuple[int, int], int] = {}
    paired = []
    for codes in terms:
        heavy = sorted((c for c in codes if weight[c] > 0), key=lambda c: (-weight[c], c))
        pairs = [(a, b) if a < b else (b, a) for a, b in zip(heavy[::2], heavy[1::2] + heavy[-1:], strict=False)]
        paired.append([places.setdefault(p, len(places)) for p in pairs])
    return paired, list(places)


def _peaks(blocks: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ascending blocks and the greatest value of each."""
    if not len(blocks):
        return blocks, values
    first = np.flatnonzero(np.diff(blocks, prepend=-1))
    return blocks[first], np.maximum.reduceat(values, first)


def build_segment(ids: list, sizes: np.ndarray, codes: np.ndarray, counts: np.ndarray, lengths: np.ndarray, weight: np.ndarray, pairs: np.ndarray, n_docs: int, n_terms: int) -> dict:
    """Lists and pair lists of a run of documents; ``codes`` and ``counts`` lie behind each other, ``lengths`` a document."""
    norm = 10 + (90 * sizes * n_docs) // n_terms
    local = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
    tf = counts.astype(np.int64)
    impacts = weight[codes] * ((1_000_000_000 * tf) // (1000 * tf + 8 * norm[local]))
    some = np.flatnonzero(impacts)
    order = some[np.argsort(codes[some], kind="stable")]
    codes, local, impacts = codes[order], local[order], impacts[order]
    terms, starts = np.unique(codes, return_index=True)
    ends = np.append(starts[1:], len(codes)).astype(np.int32)
    place = np.full(len(weight), -1)
    place[terms] = np.arange(len(terms))
    dense = np.zeros(len(ids), np.int64)
    held, held_ends, blocks, peaks, total = [], [], [], [], 0
    left, right = (place[pairs[:, k]] for k in (0, 1)) if len(pairs) else (np.zeros(0, int),) * 2
    both = np.flatnonzero((left >= 0) & (right >= 0) & (left != right))
    for p in both[np.argsort(left[both], kind="stable")].tolist():
        a, b = (slice(starts[x], ends[x]) for x in (left[p], right[p]))
        dense[local[a]] = impacts[a]
        other = dense[local[b]]
        joint = np.flatnonzero(other)
        if len(joint):
            at, peak = _peaks(local[b][joint] // BLOCK_DOCS, other[joint] + impacts[b][joint])
            total += len(at)
            held.append(p)
            held_ends.append(total)
            blocks.append(at)
            peaks.append(peak)
        dense[local[a]] = 0
    none = [np.zeros(0, np.int64)]
    return {
        "docs": ids, "terms": terms.astype(np.int32), "ends": ends, "locals": local, "impacts": impacts, "pairs": np.array(held, np.int32),
        "pair_ends": np.array(held_ends, np.int32), "pair_blocks": np.concatenate(blocks or none).astype(np.int32), "pair_peaks": np.concatenate(peaks or none),
    }


def build_index(forward: DataFrame, weight: np.ndarray, pairs: list[tuple[int, int]], n_docs: int, n_terms: int, segment_docs: int = SEGMENT_DOCS) -> DataFrame:
    """One row per segment of documents."""
    pair_codes = np.array(pairs, np.int64).reshape(-1, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def segment(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts).combine_chunks()
            lists = [table.column(c).combine_chunks() for c in ("codes", "counts")]
            lengths = lists[0].value_lengths().to_numpy(zero_copy_only=False)
            ids, sizes = table.column("doc_id").to_pylist(), table.column("n").to_numpy()
            made = build_segment(ids, sizes, *(x.flatten().to_numpy() for x in lists), lengths, weight, pair_codes, n_docs, n_terms)
            kinds = {"docs": pa.int64(), "impacts": pa.int64(), "pair_peaks": pa.int64()}
            return pa.RecordBatch.from_arrays([pa.array([v], pa.list_(kinds.get(k, pa.int32()))) for k, v in made.items()], names=list(made))

        rows = postings = 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_DOCS):
                part = batch.slice(at, BLOCK_DOCS)
                size = part.column(2).flatten()
                if held and (rows + part.num_rows > segment_docs or postings + len(size) > SEGMENT_POSTINGS):
                    yield segment(held)
                    held, rows, postings = [], 0, 0
                held.append(part)
                rows, postings = rows + part.num_rows, postings + len(size)
        if held:
            yield segment(held)

    return forward.mapInArrow(run, _INDEX)


class Best:
    """The best few documents of an item so far."""

    def __init__(self, top: int) -> None:
        self.top, self.rows = top, []

    @property
    def least(self) -> int:
        """Scores below this cannot enter; 1 while there is room."""
        return -self.rows[-1][0] if len(self.rows) == self.top else 1

    def offer(self, scores: list[int], ids: list) -> None:
        found = [(-s, i is None, 0 if i is None else i) for s, i in zip(scores, ids, strict=True)]
        self.rows = sorted(self.rows + found)[: self.top]


class Segment:
    """A segment read from the index, with the bound of every pair in every block."""

    def __init__(self, row: dict[str, np.ndarray], ids: list, pairs: np.ndarray, n_codes: int) -> None:
        self.ids, self.locals, self.impacts = ids, row["locals"], row["impacts"]
        self.n_blocks = -(-len(ids) // BLOCK_DOCS)
        place = np.full(n_codes, -1)
        place[row["terms"]] = np.arange(len(row["terms"]))
        starts = np.append(0, row["ends"][:-1])
        # the single maxima of every list, then the joint ones of the pair lists
        single = np.zeros((len(starts) + 1, self.n_blocks), np.int64)
        self.lists = [slice(a, b) for a, b in zip(starts.tolist(), row["ends"].tolist(), strict=True)]
        for at, part in enumerate(self.lists):
            blocks, peaks = _peaks(self.locals[part] // BLOCK_DOCS, self.impacts[part])
            single[at, blocks] = peaks
        self.sides = place[pairs]
        self.bounds = np.maximum(single[self.sides[:, 0]], single[self.sides[:, 1]])
        begin = 0
        for pair, end in zip(row["pairs"].tolist(), row["pair_ends"].tolist(), strict=True):
            blocks = row["pair_blocks"][begin:end]
            self.bounds[pair, blocks] = np.maximum(self.bounds[pair, blocks], row["pair_peaks"][begin:end])
            begin = end

    def _sides(self, pair: int) -> list[slice]:
        return [self.lists[x] for x in dict.fromkeys(self.sides[pair].tolist()) if x >= 0]

    def _scores(self, pairs: list[int], rest: np.ndarray, chosen: np.ndarray, best: Best) -> None:
        """Score the documents of the chosen blocks as far as they may reach the best."""
        block = np.arange(len(self.ids)) // BLOCK_DOCS
        alive, total, least = chosen[block], np.zeros(len(self.ids), np.int64), best.least
        left = int(alive.sum())
        for at, pair in enumerate(pairs):
            for part in self._sides(pair):
                docs, impacts = self.locals[part], self.impacts[part]
                if left * 8 < len(docs):
                    wanted = np.flatnonzero(alive)
                    found = np.minimum(np.searchsorted(docs, wanted), len(docs) - 1)
                    hit = docs[found] == wanted
                    total[wanted[hit]] += impacts[found[hit]]
                else:
                    total[docs] += impacts
            alive &= total + rest[at + 1][block] >= least
            left = int(alive.sum())
            if not left:
                return
        kept = np.flatnonzero(alive)
        if len(kept) > best.top:  # all that tie with the last one stay
            kept = kept[total[kept] >= np.partition(total[kept], -best.top)[-best.top]]
        best.offer(total[kept].tolist(), [self.ids[i] for i in kept.tolist()])

    def search(self, pairs: list[int], best: Best) -> None:
        bounds = self.bounds[pairs]
        rest = np.zeros((len(pairs) + 1, self.n_blocks), np.int64)
        rest[:-1] = np.cumsum(bounds[::-1], axis=0)[::-1]
        whole = rest[0]
        seeds = np.zeros(self.n_blocks, bool)
        seeds[np.argsort(-whole, kind="stable")[:SEED_BLOCKS]] = True
        for chosen in (seeds, ~seeds):
            chosen = chosen & (whole >= best.least)
            if chosen.any():
                self._scores(pairs, rest, chosen, best)


def search_index(index: DataFrame, ids: list, id_type, paired: list[list[int]], pairs: list[tuple[int, int]], n_codes: int, top: int = TOP) -> DataFrame:
    """The best documents of every item, of each task."""
    pair_codes = np.array(pairs, np.int64).reshape(-1, 2)
    kind = to_arrow_type(id_type)
    names = [f.split()[0] for f in _INDEX.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in paired]
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: c[at].values.to_numpy(zero_copy_only=False) for n, c in zip(names[1:], batch.columns[1:], strict=True)}
                segment = Segment(row, batch.column(0)[at].values.to_pylist(), pair_codes, n_codes)
                for mine, own in zip(paired, best, strict=True):
                    if mine:
                        segment.search(mine, own)
        found = [(i, None if none else doc, -score) for i, own in zip(ids, best, strict=True) for score, none, doc in own.rows]
        items, docs, scores = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(items, kind), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())], names=["item_id", "doc_id", "score"])

    return index.mapInArrow(run, f"item_id {id_type.simpleString()}, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS, segment_docs: int = SEGMENT_DOCS) -> DataFrame:
    """The ``top`` documents of every item: ``item_id``, ``rank``, ``doc_id``, ``score``."""
    kind = items.schema[item_col].dataType
    candidates = None
    for block in item_blocks(items, item_col, item_text, block_terms):
        forward = materialize(frequencies(docs, block.codes, id_col, text_col), "frequencies")
        n_docs, n_terms = forward.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        weight = term_weights(forward, n_docs, len(block.codes))
        paired, pairs = pair_up(block.terms, weight)
        if not pairs:
            continue
        index = materialize(build_index(forward, weight, pairs, n_docs, n_terms, segment_docs), "segments")
        found = materialize(search_index(index, block.ids, kind, paired, pairs, len(weight), top), "candidates")
        candidates = found if candidates is None else candidates.union(found)
    if candidates is None:
        return docs.sparkSession.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    line = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = candidates.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def sql(top: int = TOP) -> str:
    """DuckDB text for ``rank`` of ``documents`` for the items of ``benchmark``."""
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '{PLAIN_PATTERN}')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {words} AS w FROM documents),
sizes AS (SELECT row, doc_id, len(w)::BIGINT AS n, (count(*) OVER ())::BIGINT AS nn, (sum(len(w)) OVER ())::BIGINT AS l FROM docs WHERE len(w) > 0),
terms AS (SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(w) AS term FROM docs) GROUP BY ALL),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({words}) AS term FROM benchmark)),
weights AS (
  SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM terms JOIN sizes USING (row) WHERE term IN (SELECT term FROM asked) GROUP BY term, nn),
impacts AS (
  SELECT row, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // l))) AS impact
  FROM terms JOIN weights USING (term) JOIN sizes USING (row)),
scores AS (SELECT item_id, row, any_value(doc_id) AS doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY item_id, row),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {top}
"""
