import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from panelforge.llm import pair_maxscore as pm
from tests.llm.frames import awkward_documents, documents, empty_documents
from tests.oracle import compare


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    counted = [(doc, Counter(words(text))) for doc, text in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(words(text))
    out = Counter()
    for item, terms in asked.items():
        scored = []
        for doc, c in counted:
            m = 10 + (90 * sum(c.values()) * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out.update((item, k + 1, doc, -s) for k, (s, _, _, doc) in enumerate(sorted(scored, key=lambda r: r[:3])[:top]))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def rows_of(df):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


@pytest.fixture
def corpus():
    """Common and rare words, ties, copies, and items with many and few terms."""
    rng = random.Random(11)
    pool = [f"t{int(rng.paretovariate(0.6))}" for _ in range(3000)]
    texts = [" ".join(rng.choices(pool, k=rng.randrange(1, 60))) for _ in range(700)]
    texts[100:140] = [texts[100]] * 40
    items = [(k, " ".join(rng.choices(pool, k=rng.randrange(1, 25)))) for k in range(30)] + [(30, texts[100]), (31, "t1"), (32, "nowhere at all")]
    return list(enumerate(texts)), items


@pytest.mark.parametrize(("block_terms", "segment_docs", "block_docs"), [(200_000, 8192, 64), (40, 100, 4), (200_000, 64, 1)])
def test_against_brute_force(spark, corpus, block_terms, segment_docs, block_docs, monkeypatch):
    docs, items = corpus
    if block_docs == 64:  # workers read the module anew, so other block sizes are tried without Spark below
        found = pm.rank(documents(spark, docs).repartition(3), frame(spark, items), block_terms=block_terms, segment_docs=segment_docs)
        assert rows_of(found) == brute(docs, items)
    monkeypatch.setattr(pm, "BLOCK_DOCS", block_docs)
    assert search_here(docs, items, segment_docs) == brute(docs, items)


def search_here(docs, items, segment_docs, top=10, visited=None):
    """The same index and search without Spark."""
    asked = {i: sorted(set(words(t))) for i, t in items}
    codes = {t: k for k, t in enumerate(sorted({t for ts in asked.values() for t in ts}))}
    counted = [(d, Counter(words(t))) for d, t in docs]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(codes[t] for _, c in counted for t in c if t in codes)
    weight = np.zeros(len(codes), np.int64)
    for code, n in df.items():
        weight[code] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))
    paired, pairs = pm.pair_up([[codes[t] for t in ts] for ts in asked.values()], weight)
    pairs = np.array(pairs)
    best = [pm.Best(top) for _ in asked]
    for at in range(0, len(counted), segment_docs):
        part = counted[at : at + segment_docs]
        known = [[(codes[t], n) for t, n in c.items() if t in codes] for _, c in part]
        flat = np.array([p for k in known for p in k]).reshape(-1, 2)
        row = pm.build_segment([d for d, _ in part], np.array([sum(c.values()) for _, c in part]), flat[:, 0], flat[:, 1], np.array([len(k) for k in known]), weight, pairs, n_docs, n_terms)
        segment = pm.Segment(row, row["docs"], pairs, len(weight))
        if visited is not None:
            visited.append((segment, row))
        for mine, own in zip(paired, best, strict=True):
            if mine:
                segment.search(mine, own)
    return Counter((i, k + 1, doc, -s) for i, own in zip(asked, best, strict=True) for k, (s, _, doc) in enumerate(own.rows))


def test_pair_bounds_are_joint_maxima(corpus):
    """A pair's bound is the greatest sum of its two impacts over the documents of a block, and often below the sum of the maxima."""
    docs, items = corpus
    visited = []
    search_here(docs, items, 256, visited=visited)
    tighter = 0
    for segment, _ in visited:
        for pair in range(len(segment.bounds)):
            exact = np.zeros(segment.n_blocks * pm.BLOCK_DOCS, np.int64)
            apart = np.zeros(segment.n_blocks, np.int64)
            for part in segment._sides(pair):
                exact[segment.locals[part]] += segment.impacts[part]
                single = np.zeros_like(exact)
                single[segment.locals[part]] = segment.impacts[part]
                apart += single.reshape(-1, pm.BLOCK_DOCS).max(axis=1)
            assert (segment.bounds[pair] == exact.reshape(-1, pm.BLOCK_DOCS).max(axis=1)).all()
            tighter += int((segment.bounds[pair] < apart).sum())
    assert tighter > 100


def test_awkward_rows(spark):
    docs = awkward_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(1, "ONE two, thirteen"), (1, "seven"), (2, None), (3, ""), (4, "été inside W5 x3"), (None, "twelve a"), (6, "startoftext")]
    assert rows_of(pm.rank(docs, frame(spark, items))) == brute(rows, items)
    assert rows_of(pm.rank(docs, frame(spark, items), top=2)) == brute(rows, items, 2)


def test_empty_tables(spark):
    items = frame(spark, [(1, "a b")])
    assert pm.rank(empty_documents(spark), items).count() == 0
    none = pm.rank(documents(spark, [(1, "a b")]), items.where("false"))
    assert none.count() == 0 and none.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert pm.rank(documents(spark, [(1, None), (2, " ")]), items).count() == 0


def test_against_sql_on_awkward_rows(spark):
    import duckdb

    docs = awkward_documents(spark)
    duck = duckdb.connect()
    duck.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?)", [(r["doc_id"], r["text"]) for r in docs.collect()])
    items = [(1, "one two w1 w2"), (2, "x1 A")]
    duck.sql("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert compare(pm.rank(docs, frame(spark, items)).toPandas(), duck.sql(pm.sql()).df()) == "ok"
