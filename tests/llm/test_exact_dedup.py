import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from panelforge.llm import cuckoo_dedup as cd
from tests.llm.frames import awkward_documents, documents, empty_documents
from tests.llm.twins import against_sql


def brute(rows):
    found = defaultdict(list)
    for doc, text in rows:
        found[text or ""].append(doc)
    out = Counter()
    for text, ids in found.items():
        known = [i for i in ids if i is not None]
        keep = max(known, default=None)
        stays = True
        for doc in ids:
            kept, stays = (True, False) if stays and doc == keep else (False, stays)
            out[doc, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def rows_of(df):
    return Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect())


def copies(n, hot, seed=3):
    rng = random.Random(seed)
    texts = [f"text {rng.randrange(n // 2)}" for _ in range(n)] + ["the hot one"] * hot
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("shard_keys", [7, 50_000])
def test_against_brute_force(spark, shard_keys):
    rows = copies(400, 200)
    assert rows_of(cd.groups(documents(spark, rows).repartition(5), shard_keys=shard_keys)) == brute(rows)


def test_awkward_rows(spark):
    docs = awkward_documents(spark)
    assert rows_of(cd.groups(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    against_sql(docs, cd.groups, cd.sql())
    left = cd.without_copies(docs)
    assert left.columns == docs.columns and left.count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert cd.groups(empty_documents(spark)).count() == 0 and cd.without_copies(empty_documents(spark)).count() == 0


def key(i):
    return hashlib.sha256(str(i).encode()).digest()


def test_filter_holds_exactly_the_live_digests():
    """Thousands of insertions and deletions in random order against a dictionary; the table doubles on the way."""
    rng, index, live = random.Random(8), cd.CuckooIndex(2), {}
    for step in range(12_000):
        k = rng.randrange(3_000)
        if rng.random() < 0.3:
            assert index.delete(key(k)) == (live.pop(k, None) is not None)
        else:
            new = k not in live
            assert index.insert(key(k), (step, 0, step, 1)) == new
            live[k] = (step, 1 + live.get(k, (0, 0))[1])
    assert index.resizes > 5 and index.live == len(live)
    for k in range(3_000):
        got = index.get(key(k))
        assert (got is None) == (k not in live)
        assert got is None or (got[0], got[3]) == live[k]
    columns = index.columns()
    again = cd.CuckooIndex.of(columns)
    assert all((again.get(key(k)) is None) == (k not in live) for k in range(3_000)) and len(columns["sizes"]) == len(live)


def test_equal_marks_are_told_apart_by_the_stored_digest():
    """Digests that differ only behind the bytes of mark and bucket share both; each is found."""
    index = cd.CuckooIndex(1024)
    alike = [b"\x07" * 10 + bytes([i]) * 22 for i in range(8)]
    assert all(index.insert(d, (i, 0, i, 1)) for i, d in enumerate(alike))
    assert index.false_hits > 0 and [index.get(d)[0] for d in alike] == list(range(8))
    assert index.delete(alike[3]) and index.get(alike[3]) is None and index.get(alike[4])[0] == 4


def test_overflow_doubles_from_the_stored_keys():
    index = cd.CuckooIndex(1)
    for i in range(100):
        index.insert(key(i), (i, 0, i, 1))
    assert index.resizes >= 4 and all(index.get(key(i))[0] == i for i in range(100))


def test_insertion_and_deletion_of_tables(spark):
    first, second = copies(120, 30, 1), [(1000 + i, t) for i, t in copies(90, 10, 2)]
    index = cd.update(None, cd.digest_rows(documents(spark, first)), shard_keys=20)
    index = cd.update(index, cd.digest_rows(documents(spark, second)), shard_keys=20)
    both = brute(first + second)
    assert {(r["digest"].hex(), r["doc_id"], r["n"]) for r in cd.stored_keys(index).collect()} == {(d, keep, n) for _, keep, n, _, d in both}
    gone = {t for _, t in first[:40]}
    index = cd.update(index, gone=cd.digest_rows(documents(spark, first[:40])), shard_keys=20)
    rest = [(i, t) for i, t in first + second if t not in gone]
    assert sum(r["n"] for r in cd.stored_keys(index).collect()) == len(rest)
    found = cd.known(documents(spark, first), index)
    assert sorted(r["doc_id"] for r in found.collect()) == sorted(i for i, t in first if t not in gone)
    grown = cd.update(index, cd.digest_rows(documents(spark, [(5000 + i, f"new {i}") for i in range(400)])), shard_keys=20)
    assert grown.agg(F.max("shards")).first()[0] > index.agg(F.max("shards")).first()[0]
    assert cd.stored_keys(grown).count() == len({t for _, t in rest}) + 400
