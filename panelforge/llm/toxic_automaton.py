"""Toxicity by a learned lexicon, matched with a Levenshtein automaton, and the context of each match.

Terms are learned from labelled rows: words, and stems with any ending, that stand in toxic texts and hardly elsewhere, in
many different neighbourhoods (so words of one text that was copied often do not count).  They form a trie.  The trie is
intersected with Levenshtein automata lazily: a state is the set of trie nodes reached with the fewest edits, transitions
are kept as they are met, and most words leave the automaton after a few letters.  Every match is a feature of its term,
of being exact or misspelled, and of its context window: inside quotation marks or after a verb of speech it may be a
report of abuse rather than abuse.  Feature weights are log ratios of their document counts in the two classes.

The fit reads at most ``MAX_LABELLED`` labelled rows, those of smallest hash, and keeps every term that passes its tests;
scores are computed for all texts, whole.  How often a term must occur follows from the terms that chance alone would let
pass.  A word that matches nothing is tried once more by its parts between dashes, slashes and dots.
A text without a match always scores below one half, whatever the share of toxic labels.
Defined results: NULL and empty texts have no match and get the score of texts without any; without labelled rows of both
kinds every score is 0; labels given twice for a document count as toxic if one of them does; repeated rows each get their
score; an empty table gives an empty table; extra columns are ignored, or passed through by ``without_toxic``.
"""

from __future__ import annotations

import math
import re
import string
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import append_columns, bounded_batches, fresh
from panelforge.storage import materialize

MAX_LABELLED = 20_000
FOLDS = 5

#: Lexicon: stem lengths tried, toxic share, different neighbours and toxic texts asked for, share of chance terms allowed.
STEM_LENGTHS = (4, 5, 6, 7)
MIN_PRECISION = 0.9
MIN_NEIGHBOURS = 4
MIN_TEXTS = 3
MAX_CHANCE = 0.001

#: Highest score of a text without any match.
UNMATCHED = 0.49

#: Weight of a text's further matches, and documents that the assumed weight of a misspelling counts for.
FURTHER = 0.1
ASSUMED_ROWS = 2.0

#: Words on either side of a match that are searched for quotation marks and verbs of speech.
WINDOW = 8
SPEECH = frozenset("said says say wrote writes called calls quoted quote quotes term word word's".split())
_OPEN, _CLOSE = "\"“„«‹'‘", "\"”“»›'’"

_EDGES = string.punctuation + "“”„«»‹›‘’…–—¿¡"
_JOINTS = re.compile(r"[-‐‑–—/\\|_,.;:!?…+=~]+")
_CACHE = 200_000
_STATES = 50_000
_PLACES = 63


def bare(word: bytes) -> str:
    return word.decode("utf-8", "replace").strip(_EDGES).lower()


def edits_allowed(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


@dataclass
class Automaton:
    """The lexicon's trie intersected with the Levenshtein automata of its terms.  Terms ending in ``*`` take any ending."""

    terms: list[str]
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: dict[int, int] = field(default_factory=dict)
    stems: dict[int, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.limits = [edits_allowed(len(t.rstrip("*"))) for t in self.terms]
        room = [0]
        for number, term in enumerate(self.terms):
            node = 0
            room[0] = max(room[0], self.limits[number])
            for letter in term.rstrip("*"):
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    room.append(0)
                node = self.children[node][letter]
                room[node] = max(room[node], self.limits[number])
            (self.stems if term.endswith("*") else self.ends)[node] = number
        self.room = room
        self._reset()

    def _reset(self) -> None:
        self._ids: dict[tuple, int] = {}
        self._sets: list[tuple] = []
        self._moves: list[dict[str, int]] = []
        self._start = self._state({0: 0}, None)

    def _state(self, nodes: dict[int, int], locked: tuple[int, int] | None) -> int:
        queue = list(nodes)
        while queue:  # letters of the term that the word lacks
            node = queue.pop()
            for child in self.children[node].values():
                edits = nodes[node] + 1
                if edits <= self.room[child] and edits < nodes.get(child, 9):
                    nodes[child] = edits
                    queue.append(child)
        for node, edits in nodes.items():
            term = self.stems.get(node)
            if term is not None and edits <= self.limits[term] and (locked is None or (edits, term) < locked):
                locked = (edits, term)
        key = (tuple(sorted(nodes.items())), locked)
        if key not in self._ids:
            self._ids[key] = len(self._sets)
            self._sets.append(key)
            self._moves.append({})
        return self._ids[key]

    def _move(self, state: int, letter: str) -> int:
        found, locked = self._sets[state]
        nodes: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.room[node] and edits < nodes.get(node, 9):
                nodes[node] = edits

        for node, edits in found:
            reach(node, edits + 1)
            for own, child in self.children[node].items():
                reach(child, edits + (own != letter))
        to = self._state(nodes, locked)
        self._moves[state][letter] = to
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the closest term, or None."""
        if len(self._sets) > _STATES:
            self._reset()
        state, moves = self._start, self._moves
        for letter in word:
            state = moves[state][letter] if letter in moves[state] else self._move(state, letter)
            if not self._sets[state][0]:
                break
        nodes, best = self._sets[state]
        for node, edits in nodes:
            term = self.ends.get(node)
            if term is not None and edits <= self.limits[term] and (best is None or (edits, term) < best):
                best = (edits, term)
        return best


class Matcher(dict):
    """Memo of words to matches; emptied when full."""

    def __init__(self, terms: list[str]) -> None:
        super().__init__()
        self.automaton = Automaton(terms)

    def __missing__(self, word: bytes) -> tuple[int, int] | None:
        if len(self) >= _CACHE:
            self.clear()
        whole = bare(word) if word else ""
        found = self.automaton.match(whole) if word else None
        if found is None and _JOINTS.search(whole):
            found = min(filter(None, (self.automaton.match(p) for p in _JOINTS.split(whole) if p)), default=None)
        self[word] = found
        return found

    def features(self, text: bytes | None) -> set[tuple[int, int, int]]:
        """Distinct (term, misspelled, quoted) of a text; misspelled ones count where no term is spelled right."""
        words = text.split() if text else []
        hits = [(i, hit) for i, hit in enumerate(map(self.__getitem__, words)) if hit]
        exact = [(i, hit) for i, hit in hits if not hit[0]]
        return {(term, int(edits > 0), quotation(words, i)) for i, (edits, term) in exact or hits}


def quotation(words: list[bytes], at: int) -> int:
    """1 if the word stands in quotation marks opened and closed in the window, or close behind a verb of speech."""
    around = [w.decode("utf-8", "replace") for w in words[max(0, at - WINDOW) : at + WINDOW + 1]]
    place = min(at, WINDOW)
    opened = any(w[0] in _OPEN and not (len(w) > 1 and w.rstrip(".,;:!?")[-1:] in _CLOSE and i < place) for i, w in enumerate(around[: place + 1]))
    closed = any(w.rstrip(".,;:!?")[-1:] in _CLOSE for w in around[place:] if w.rstrip(".,;:!?"))
    spoken = any(w.strip(_EDGES).lower() in SPEECH for w in around[max(0, place - 3) : place])
    return int((opened and closed) or spoken)


@dataclass
class Model:
    terms: list[str]
    weights: dict[tuple[int, int, int], float]
    prior: float | None  # log odds of a text without matches are prior + none
    none: float = 0.0

    def score(self, features: set[tuple[int, int, int]]) -> float:
        if self.prior is None:
            return 0.0
        if not features:
            return min(UNMATCHED, 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.prior + self.none)))))
        weights = sorted(((self.weights.get(f, 0.0), f) for f in features), reverse=True)
        # terms of a text go together, so the strongest match counts in full and each further one a little
        total = weights[0][0] + sum(FURTHER * w for w, _ in weights[1:] if w > 0)
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.prior + total))))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_rows: int) -> DataFrame:
    """(``text``, ``toxic``) of labelled rows outside the held-out fold; at most ``max_rows`` ids are broadcast."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != 0)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return narrow.join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per term: toxic texts, other texts, and a 63-bit map of the words it follows in toxic texts."""
    counts: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])

    def flush() -> pa.RecordBatch:
        columns = list(zip(*((t, *c) for t, c in counts.items()), strict=True))
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], names=["term", "pos", "neg", "after"])

    for batch in batches:
        for text, toxic in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
            before, seen = b"", {}
            for word in (text or b"").split():
                term = bare(word)
                if len(term) > 2 and term.isalpha():
                    bit = 1 << crc32(before) % _PLACES
                    for t in (term, *(term[:n] + "*" for n in STEM_LENGTHS if len(term) >= n)):
                        seen[t] = seen.get(t, 0) | bit
                before = word
            for t, bits in seen.items():
                entry = counts[t]
                entry[0 if toxic else 1] += 1
                entry[2] |= bits if toxic else 0
            if len(counts) > 200_000:
                yield flush()
    if counts:
        yield flush()


def chance_of(n: int, share: float) -> float:
    """Probability that of ``n`` texts drawn at random at least ``MIN_PRECISION`` are toxic."""
    least = math.ceil(MIN_PRECISION * n - 1e-9)
    logs = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log1p(-share) for k in range(least, n + 1)]
    return min(1.0, sum(map(math.exp, logs)))


def texts_needed(held: list[tuple[int, int, int]], share: float) -> int:
    """Least toxic texts of a term, from (texts, terms in so many, those that pass the other tests) and the toxic share.

    The smallest number from which on chance would let less than half a term pass, or less than ``MAX_CHANCE`` of those that
    do.  Terms without any meaning are told by those that do not pass: of m in n texts each, m (1 - chance) would not.
    """
    needed, by_chance, passing = MIN_TEXTS, 0.0, 0
    for n, terms, passed in sorted(held, reverse=True):
        if n < MIN_TEXTS:
            break
        chance = chance_of(n, share)
        by_chance, passing = by_chance + (terms - passed) * chance / max(1e-9, 1.0 - chance), passing + passed
        if by_chance > max(0.5, MAX_CHANCE * passing):
            needed = max(needed, n + 1) if needed == MIN_TEXTS else needed
        else:
            needed = MIN_TEXTS
    return needed


def choose_terms(candidates: list[tuple[str, int]]) -> list[str]:
    """Of nested candidates (term, toxic texts), the most special one that still covers nearly the same texts."""
    count = dict(candidates)

    def covers(stem: str, term: str) -> bool:
        return term != stem and term.rstrip("*").startswith(stem[:-1])

    stems = [t for t in count if t.endswith("*")]
    inside: dict[str, list[str]] = defaultdict(list)
    for term in count:
        base = term.rstrip("*")
        for n in STEM_LENGTHS:
            stem = base[:n] + "*"
            if stem in count and covers(stem, term):
                inside[stem].append(term)
    dropped: set[str] = set()
    for stem in sorted(stems, key=len):
        special = [t for t in inside[stem] if count[t] >= 0.95 * count[stem]]
        if special:
            dropped.add(stem)
        elif stem not in dropped:
            dropped.update(inside[stem])
    return sorted((t for t in count if t not in dropped), key=lambda t: (-count[t], t))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_LABELLED) -> Model:
    """Learn lexicon and weights.  What reaches the driver are terms of at least three of the at most ``max_rows`` labelled texts."""
    bounded_batches(docs.sparkSession)
    rows = materialize(training_rows(docs, labels, id_col, text_col, max_rows), "labelled")
    totals = rows.agg(F.sum("toxic").alias("pos"), F.count("*").alias("n")).first()
    positive, negative = totals["pos"] or 0, totals["n"] - (totals["pos"] or 0)
    if not positive or not negative:
        return Model([], {}, None)
    counted = rows.mapInArrow(_term_counts, "term string, pos long, neg long, after long")
    counted = counted.groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.bit_or("after").alias("after")).where("pos > 1")
    counted = materialize(counted, "terms")
    # a term must follow at least half as many different words as it would if it stood in different places everywhere
    spread = 0.5 * _PLACES * (1.0 - F.exp(-F.col("pos") / _PLACES))
    passes = (F.col("pos") >= MIN_PRECISION * (F.col("pos") + F.col("neg"))) & (
        F.bit_count("after") >= F.greatest(F.lit(float(MIN_NEIGHBOURS)), spread)
    )
    # and stand in so many toxic texts that chance would not give many such terms among all: one row per number of texts
    held = counted.groupBy((F.col("pos") + F.col("neg")).alias("n")).agg(F.count("*").alias("terms"), F.count_if(passes).alias("passed"))
    enough = texts_needed([(r["n"], r["terms"], r["passed"]) for r in held.collect()], positive / (positive + negative))
    found = counted.where(passes & (F.col("pos") >= enough))
    candidates = [(r["term"], r["pos"]) for r in found.collect()]
    terms = choose_terms(candidates)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms)
        counts: dict[tuple, list[int]] = defaultdict(lambda: [0, 0])
        for batch in batches:
            for text, toxic in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for f in matcher.features(text) or {(-1, 0, 0)}:
                    counts[f][0 if toxic else 1] += 1
        if counts:
            columns = list(zip(*((*f, *c) for f, c in counts.items()), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["term", "misspelled", "quoted", "pos", "neg"])

    measured = rows.mapInArrow(present, "term long, misspelled long, quoted long, pos long, neg long")
    measured = measured.groupBy("term", "misspelled", "quoted").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    seen = {(r["term"], r["misspelled"], r["quoted"]): (r["pos"], r["neg"]) for r in measured.collect()}

    def ratio(key: tuple[int, int, int]) -> float:
        pos, neg = seen.get(key, (0, 0))
        return math.log((pos + 0.5) / (positive + 1.0)) - math.log((neg + 0.5) / (negative + 1.0))

    def towards(key: tuple[int, int, int], assumed: float) -> float:
        n = sum(seen.get(key, (0, 0)))
        return (n * ratio(key) + ASSUMED_ROWS * assumed) / (n + ASSUMED_ROWS)

    none = ratio((-1, 0, 0))
    weights = {}
    for number in range(len(terms)):
        weights[number, 0, 0] = ratio((number, 0, 0))
        weights[number, 1, 0] = towards((number, 1, 0), 0.75 * weights[number, 0, 0])
        for misspelled in (0, 1):  # a report of abuse is assumed to weigh half as much
            weights[number, misspelled, 1] = towards((number, misspelled, 1), 0.5 * weights[number, misspelled, 0])
    return Model(terms, weights, math.log(positive / negative), none)


def with_scores(docs: DataFrame, model: Model, text_col: str, name: str) -> DataFrame:
    def scorer():
        matcher = Matcher(model.terms)
        return lambda texts: [[model.score(matcher.features(t)) for t in texts]]

    return append_columns(docs, text_col, [(name, "double")], scorer)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_LABELLED) -> DataFrame:
    """One row per document: whether its label was held out, its score, and the verdict."""
    model = fit(docs, labels, id_col, text_col, max_rows)
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    scored = with_scores(narrow, model, "text", "score")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_LABELLED) -> DataFrame:
    """``docs`` without the documents that score 0.5 or more."""
    model = fit(docs, labels, id_col, text_col, max_rows)
    name = fresh(docs, "toxic_score")
    return with_scores(docs, model, text_col, name).where(F.col(name) < 0.5).drop(name)
