import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelforge.llm import simhash_tiles
from panelforge.llm.components import stars
from tests.llm.frames import awkward_documents, empty_documents


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    out = 0
    for bit in range(64):
        votes = sum(h >> bit & 1 for h in hashes)
        out |= (1 << bit) if votes * 2 > len(shingles) else 0
    return out


def slow_components(rows, radius=2):
    """(id, fingerprint) to the smallest id reachable, by comparing all pairs."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if (a ^ b).bit_count() <= radius:
                root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return [low.get(find(i)) for i in range(len(rows))]


@given(st.text(alphabet="aB é\n\t z", max_size=60))
@settings(max_examples=80, deadline=None)
def test_fingerprint_against_bit_by_bit(text):
    assert simhash_tiles.fingerprint(text.encode()) % (1 << 64) == slow_fingerprint(text)


def test_wordless_texts_have_fingerprint_zero():
    assert [simhash_tiles.fingerprint(t) for t in (None, b"", b" \n\t")] == [0, 0, 0]


def test_links_connect_exactly_what_close_pairs_connect(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-(1 << 63), 1 << 63, 40, dtype=np.int64)
    rows = list(base)
    for _ in range(360):  # chains of one to three flipped bits, so that links cross shapes
        value = int(rng.choice(rows)) % (1 << 64)
        for bit in rng.integers(0, 64, rng.integers(1, 4)):
            value ^= 1 << int(bit)
        rows.append(np.uint64(value).astype(np.int64))
    prints = spark.createDataFrame([(int(x),) for x in rows], "fp long")
    expected = slow_components([(int(x), int(x) % (1 << 64)) for x in rows])
    for tile_rows in (3, 2048):
        found = {r["fp"]: r["root"] for r in simhash_tiles.near_duplicates(prints, 2, tile_rows).collect()}
        ours = {}
        for x, c in zip(rows, expected, strict=True):
            ours.setdefault(c, set()).add(found[int(x)])
        assert all(len(v) == 1 for v in ours.values()) and len({next(iter(v)) for v in ours.values()}) == len(ours)


def test_a_large_group_of_near_copies_gives_one_link_for_each_at_most():
    values = np.array([(1 << a) | (1 << b) for a in range(40) for b in range(a)], np.int64)
    a, b = simhash_tiles.linked_to_smallest(values, values, 2)
    assert len(a) <= 2 * len(values)
    root = dict(zip(a.tolist(), b.tolist(), strict=True))
    assert {root.get(int(x), int(x)) for x in values} == {int(values[0])}


def test_components_of_a_long_chain(spark):
    n = 60
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1000), (2000, 1500), (1500, 2000)], "a long, b long")
    found = {r["node"]: r["root"] for r in stars(links).collect()}
    assert found == {**{i: 0 for i in range(1, n + 1)}, 2000: 1500}


def test_query_against_brute_force(spark):
    docs = awkward_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    prints = [(doc, slow_fingerprint(text)) for doc, text in rows]
    expected = sorted(((doc, f"{fp:016x}", c) for (doc, fp), c in zip(prints, slow_components(prints), strict=True)), key=str)
    assert sorted((tuple(r) for r in simhash_tiles.classes(docs).collect()), key=str) == expected


def test_one_row_of_each_group_stays_with_all_columns(spark):
    docs = awkward_documents(spark)
    kept = simhash_tiles.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], slow_fingerprint(r["text"])) for r in docs.collect()]
    classes = {str(c) for c in slow_components(rows)}
    assert kept.count() == len(classes)
    assert kept.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").isEmpty()


def test_empty_table(spark):
    assert simhash_tiles.classes(empty_documents(spark)).count() == 0
    assert simhash_tiles.keep_one(empty_documents(spark)).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_every_close_pair_of_shapes_is_visited_once(radius):
    steps = simhash_tiles.neighbour_steps(radius)
    assert len({s for s, _ in steps}) == len(steps)
    assert len(steps) == {0: 1, 1: 5, 2: 21}[radius]
