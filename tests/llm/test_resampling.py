import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from panelforge.llm import importance_resampling as ir
from tests.llm.frames import awkward_documents, documents, empty_documents
from tests.oracle import compare


def runs(text):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().translate(bytes.maketrans(*(s.encode() for s in (ir.CAPITALS, ir.SMALL)))))
    return words, [b" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(docs, target, percent=5, min_words=20):
    """(doc_id, n_features, weight, score, rank) of every row."""
    source, wanted = Counter(), Counter()
    for counts, rows in ((source, [t for _, t in docs]), (wanted, target)):
        for text in rows:
            counts.update(crc32(f) % 10000 for f in runs(text)[1])
    s, t = sum(source.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log(((wanted[b] + 1.0) * (s + 10000)) / ((source[b] + 1.0) * (t + 10000)))) for b in range(10000)]
    out = []
    for doc, text in docs:
        words, features = runs(text)
        h = int(hashlib.sha256(f"42:{'null' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[crc32(f) % 10000] for f in features)
        out.append([doc, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    fit = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, row in enumerate(fit[: percent * len(fit) // 100]):
        row[4] = place + 1
    return Counter(tuple(r[:5]) for r in out)


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


@pytest.fixture
def some_texts():
    rng = random.Random(5)
    pool = [f"w{rng.randrange(400)}" for _ in range(300)] + ["Été", "naïve", "x" * 90, "日本", "A"]
    return [rng.choice([" ", ", ", "\n"]).join(rng.choices(pool, k=rng.randrange(80))) for _ in range(300)]


@pytest.mark.parametrize("percent", [5, 40])
def test_against_brute_force(spark, some_texts, percent):
    target = some_texts[:5] + ["w1 w2 w3 w4", None, ""]
    found = ir.resample(documents(spark, list(enumerate(some_texts))), frame(spark, target), percent=percent).collect()
    assert Counter(map(tuple, found)) == brute(list(enumerate(some_texts)), target, percent)
    assert sum(r["rank"] is not None for r in found) > 10


def test_awkward_rows(spark):
    docs = awkward_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    target = ["one two three four five", "l'école w0 x0"]
    found = ir.resample(docs, frame(spark, target), percent=60, min_words=2)
    assert Counter(map(tuple, found.collect())) == brute(rows, target, 60, 2)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in found.dtypes} == {"bigint"}


def test_empty_tables(spark):
    docs = documents(spark, [(1, "one two " * 15), (2, None)])
    assert ir.resample(empty_documents(spark), frame(spark, ["a"])).count() == 0
    found = ir.resample(docs, frame(spark, [None]).where("false"), percent=100).collect()
    assert Counter(map(tuple, found)) == brute([(1, "one two " * 15), (2, None)], [], 100)


def test_drawn_rows_keep_their_columns(spark):
    docs = awkward_documents(spark)
    rows = ir.drawn_documents(docs, frame(spark, ["one two"]), percent=50, min_words=2)
    assert rows.columns == [*docs.columns, "rank"]
    assert sorted(r["rank"] for r in rows.collect()) == list(range(1, rows.count() + 1))
    named = docs.withColumnRenamed("shard", "rank")
    assert ir.drawn_documents(named, frame(spark, ["one two"]), percent=50, min_words=2).columns == [*named.columns, "_rank"]


def test_against_sql_on_awkward_rows(spark):
    import duckdb

    docs = awkward_documents(spark).where("doc_id IS NULL OR doc_id <> 7 AND doc_id <> 8")
    duck = duckdb.connect()
    duck.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?)", [(r["doc_id"], r["text"]) for r in docs.collect()])
    duck.sql("CREATE TABLE benchmark AS SELECT 'two three four' AS text")
    found = ir.resample(docs, frame(spark, ["two three four"]), percent=50, min_words=3).toPandas()
    assert compare(found, duck.sql(ir.sql(percent=50, min_words=3)).df()) == "ok"


@pytest.mark.parametrize("length", [1, 2, 7, 64, 1000, 70_001])
def test_advanced_checksums_compose(length):
    rng = np.random.default_rng(length)
    left, right = rng.bytes(30), rng.bytes(length)
    advance = ir.Advance()
    row = advance.row(length)
    made = advance(np.array([crc32(left)], np.uint32), np.array([row]))[0] ^ np.uint32(crc32(right))
    assert int(made) == crc32(left + right)


@pytest.mark.parametrize("limit", [3, 40, 1 << 16])
def test_dictionary_of_any_size_gives_the_same(some_texts, limit, monkeypatch):
    """Words beyond the limit are hashed by themselves; texts in pieces of a few words give the same features."""
    encoded = [t.encode() for t in some_texts] + [None, b"", b" , "]
    want = [Counter(crc32(f) % 10000 for f in runs(t)[1]) for t in some_texts] + [Counter()] * 3
    for piece, step in ((1 << 20, 1 << 18), (200, 7)):
        monkeypatch.setattr(ir, "PIECE_BYTES", piece)
        monkeypatch.setattr(ir, "STEP_WORDS", step)
        monkeypatch.setattr(ir._pieces, "__defaults__", (piece,))
        words = ir.WordDictionary(limit)
        for _ in range(3):
            got = [Counter() for _ in encoded]
            sizes = np.zeros(len(encoded), int)
            for buckets, owner, n in ir.feature_buckets(encoded, words):
                sizes += n
                for b, o in zip(buckets.tolist(), owner.tolist(), strict=True):
                    got[o][b] += 1
            assert got == want and sizes[: len(some_texts)].tolist() == [len(runs(t)[0]) for t in some_texts]
        assert len(words.codes) <= limit


def test_automaton_emits_known_words_only_between_delimiters():
    words = ir.WordDictionary()
    for w in (b"the", b"he", b"other"):
        words._enter(w)
    words._rebuild()
    assert [c for _, c in words.automaton.iter(" the other  he then ")] == [0, 2, 1]
    codes, starts = words.scan(b" the other  he then ")
    assert codes.tolist() == [0, 2, 1, 3] and starts.tolist() == [1, 5, 12, 15]
