import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelforge.llm import gear_chunks
from panelforge.llm.common import identified
from tests.llm.frames import awkward_documents, documents, empty_documents


def slow_hash(data, at):
    h = 0
    for b in data[max(0, at - 63) : at + 1]:
        h = ((h << 1) + int(gear_chunks.GEAR[b])) % (1 << 64)
    return h


def slow_cuts(data):
    ends, start = [], 0
    for i in range(len(data)):
        size = i + 1 - start
        marked = slow_hash(data, i) >> (64 - gear_chunks.MASK_BITS) == 0
        if size >= gear_chunks.MAX_BYTES or (marked and size >= gear_chunks.MIN_BYTES):
            ends.append(i + 1)
            start = i + 1
    return ends + ([len(data)] if start < len(data) else [])


@given(st.binary(max_size=900))
@settings(max_examples=40, deadline=None)
def test_cuts_against_byte_by_byte(data):
    assert gear_chunks.cuts(np.frombuffer(data, np.uint8)) == slow_cuts(data)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(n))


def test_an_insertion_moves_only_the_chunks_around_it():
    text = prose(1, 2000).encode()
    changed = text[:5000] + b"inserted words here " + text[5000:]
    a, b = ({text_[s : s + n] for s, n in zip(*gear_chunks.chunk_rows(text_)[1:3], strict=True)} for text_ in (text, changed))
    assert len(a - b) <= 4


def test_chunks_rebuild_the_text(spark):
    for row in awkward_documents(spark).collect():
        data = (row["text"] or "").encode()
        digests, starts, sizes, words = gear_chunks.chunk_rows(data) if data else ([], [], [], [])
        assert b"".join(data[s : s + n] for s, n in zip(starts, sizes, strict=True)) == data
        assert sum(words) == len(data.split()) and len(digests) == len(starts)


def test_passages_are_found_and_short_lines_are_not(spark):
    line = prose(2, 13)
    rows, planted = [], {}
    for k in range(20):
        passage = prose(100 + k, 52)
        for j in range(3):
            doc = 10 * k + j
            planted.setdefault(k, set()).add(doc)
            rows.append((doc, f"{prose(1000 + doc, 40 + doc)}\n{passage}\n{prose(2000 + doc, 30)}"))
    rows += [(1000 + i, f"{line}\n{prose(5000 + i, 100)}") for i in range(40)]
    rows.append((2000, "\n".join([prose(9, 60)] * 5)))  # repeats itself only
    found = gear_chunks.repeated_spans(documents(spark, rows)).collect()
    caught = {}
    for r in found:
        caught.setdefault(r["keeper_id"], set()).add(r["doc_id"])
    assert all(caught.get(min(docs)) == docs for docs in planted.values())
    assert {r["doc_id"] for r in found} == set().union(*planted.values())
    texts = dict((r[0], r[1].encode()) for r in rows)
    for r in found:
        size = r["span_end"] - r["span_start"]
        assert texts[r["doc_id"]][r["span_start"] : r["span_end"]] == texts[r["keeper_id"]][r["keeper_start"] : r["keeper_start"] + size]
        assert r["is_keeper"] == (r["doc_id"] == r["keeper_id"])


def test_repeats_are_cut_from_all_but_the_keeper(spark):
    passage = prose(1, 80)
    docs = documents(spark, [(1, f"{prose(2, 30)} {passage}"), (2, f"{prose(3, 30)} {passage} {prose(4, 30)}"), (3, None), (None, passage)])
    texts = {r["doc_id"]: r["text"] for r in gear_chunks.without_repeats(docs).collect()}
    assert texts[1].endswith(passage) and texts[3] is None and passage not in texts[None]
    assert passage not in texts[2] and texts[2].startswith(prose(3, 30)[:150]) and len(texts[2].split()) < 90


def test_awkward_rows(spark):
    found = gear_chunks.repeated_spans(awkward_documents(spark)).collect()
    assert {r["doc_id"] for r in found} == {7, 8}  # the twelve-word line is below the limit
    assert gear_chunks.without_repeats(awkward_documents(spark)).count() == awkward_documents(spark).count()
    assert gear_chunks.repeated_spans(empty_documents(spark)).count() == 0


def test_a_passage_in_a_third_of_all_rows(spark):
    passage = prose(70_007, 60)
    rows = [(i, f"{prose(i, 20)}\n{passage}" if i % 3 == 0 else prose(i, 60)) for i in range(600)]
    found = gear_chunks.repeated_spans(documents(spark, rows)).collect()
    assert {r["doc_id"] for r in found} == set(range(0, 600, 3)) and {r["keeper_id"] for r in found} == {0}


def test_earlier_parts_do_not_hide_a_passage(spark):
    """Earlier documents hold parts of passages that two later ones share whole."""
    rows, pairs = [], {}
    for k in range(40):
        passage = prose(300 + k, 60)
        words = passage.split()
        rows.append((10 * k, f"{prose(3000 + k, 40)} {' '.join(words[20:40])} {prose(4000 + k, 30)}"))
        for j in (1, 2):
            rows.append((10 * k + j, f"{prose(5000 + 10 * k + j, 40 + j)}\n{passage}\n{prose(7000 + 10 * k + j, 30)}"))
        pairs[10 * k] = passage
    found = gear_chunks.repeated_spans(documents(spark, rows)).collect()
    texts = dict((r[0], r[1].encode()) for r in rows)
    words = {}
    for r in found:
        size = r["span_end"] - r["span_start"]
        assert texts[r["doc_id"]][r["span_start"] : r["span_end"]] == texts[r["keeper_id"]][r["keeper_start"] : r["keeper_start"] + size]
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + r["n_words"]
    assert all(words.get(k + j, 0) >= gear_chunks.MIN_SPAN_WORDS for k in pairs for j in (1, 2))
    left = {r["doc_id"]: r["text"] for r in gear_chunks.without_repeats(documents(spark, rows)).collect()}
    assert all(p in left[k + 1] and p not in left[k + 2] for k, p in pairs.items())


def test_texts_of_one_id_do_not_mix(spark):
    one, two = prose(1, 60), prose(2, 60)
    rows = [(5, one), (5, two), (5, two), (6, one), (7, two)]
    spans = gear_chunks.repeated_spans(documents(spark, rows)).collect()
    assert {r["doc_id"] for r in spans} == {5, 6, 7} and {r["keeper_id"] for r in spans} == {5}
    assert sum(r["n_words"] for r in spans if r["doc_id"] == 5) == 180 and sum(r["is_keeper"] for r in spans) == 2


def test_bit_map_and_hot_digests_lose_nothing(spark, monkeypatch):
    """A passage in every document, pieces shared by few, and the same spans whether or not digests are cut into parts or the map is full."""
    rng = random.Random(17)
    shared = " ".join(f"common{rng.randrange(900)}" for _ in range(80))
    pairs = [" ".join(f"pair{rng.randrange(900)}" for _ in range(60)) for _ in range(20)]
    rows = [(i, " ".join(f"own{rng.randrange(9000)}" for _ in range(30)) + f" {shared} " + (pairs[i // 2 % 20])) for i in range(80)]
    docs = documents(spark, rows).repartition(3)
    found = {}
    for share, bits in ((1_000, 27), (1, 27), (50, 10)):
        monkeypatch.setattr(gear_chunks, "HOT_SHARE", share)
        monkeypatch.setattr(gear_chunks, "MAX_BITS", bits)
        found[share] = sorted(map(tuple, gear_chunks.repeated_spans(docs).collect()))
    assert found[1_000] == found[1] == found[50] and {r[0] for r in found[50]} == set(range(80))


def test_marked_chunks_hold_every_copied_one(spark):
    rows = gear_chunks.text_rows(*identified(documents(spark, [(i, f"text {i // 2} of a pair " * 9) for i in range(400)])))
    every = gear_chunks.chunks(rows)
    copied = every.groupBy("hi", "lo").count().where("count > 1")
    bits = gear_chunks.bit_map(copied, copied.count())
    kept = gear_chunks.chunks(rows, bits)
    assert every.join(copied, ["hi", "lo"], "left_semi").select(kept.columns).exceptAll(kept).count() == 0
    other = gear_chunks.text_rows(*identified(documents(spark, [(i, f"{i * i} something else {i} " * 9) for i in range(300)])))
    assert gear_chunks.chunks(other, bits).count() * 4 < gear_chunks.chunks(other).count()


def slow_spans(rows, within):
    """Every span by one walk over the chunks of every text; ids tell rows apart, at most one is NULL."""
    cut, places = {}, {}
    for rank, (doc, text) in enumerate(sorted(rows, key=lambda r: (r[0] is None, r[0]))):
        digests, starts, sizes, words = gear_chunks.chunk_rows(text.encode()) if text else ([], [], [], [])
        cut[doc] = rank, list(zip(digests, starts, sizes, words, strict=True))
        for digest, start in zip(digests, starts, strict=True):
            places.setdefault(digest, []).append((rank, start, doc))
    copied = {d: min(p) for d, p in places.items() if len(p if within else {r for r, _, _ in p}) > 1}
    out = []
    for doc, (rank, line) in cut.items():
        runs, after = [], None
        for i, (digest, start, size, words) in enumerate(line):
            if digest not in copied:
                continue
            keeper, at, name = copied[digest]
            if after != i:
                runs.append([])
            if not runs[-1] or runs[-1][-1]["key"] != (keeper, start - at):
                runs[-1].append({"key": (keeper, start - at), "start": start, "words": 0, "chunks": 0, "name": name, "at": at})
            stretch = runs[-1][-1]
            stretch.update(end=start + size, words=stretch["words"] + words, chunks=stretch["chunks"] + 1)
            after = i + 1
        for run in runs:
            alone = [k for k, x in enumerate(run) if x["words"] >= gear_chunks.MIN_SPAN_WORDS]
            parts = [run[: alone[0]], run[alone[0] : alone[-1] + 1], run[alone[-1] + 1 :]] if alone else [run]
            for part in parts:
                if sum(x["words"] for x in part) >= gear_chunks.MIN_SPAN_WORDS:
                    out += [(doc, x["start"], x["end"], x["words"], x["chunks"], x["name"], x["at"], x["key"] == (rank, 0)) for x in part]
    return Counter(out)


@pytest.mark.parametrize("within", [False, True])
def test_spans_against_a_walk_over_all_chunks(spark, within):
    r = random.Random(23)
    pieces = [prose(900 + i, r.randint(5, 70)) for i in range(30)]
    rows = [(i, r.choice([" ", "\n"]).join(r.choice(pieces) if r.random() < 0.6 else prose(10_000 + 50 * i + j, 15) for j in range(r.randint(0, 12)))) for i in range(70)]
    rows += [(None, "\n".join(pieces[:5])), (500, "\n".join([prose(77, 60)] * 4)), (501, None), (502, "")]
    r.shuffle(rows)
    found = gear_chunks.repeated_spans(documents(spark, rows).repartition(4), within=within).collect()
    expected = slow_spans(rows, within)
    assert Counter(map(tuple, found)) == expected and sum(expected.values()) > 100
    assert {None} < {d for d, *_ in expected} and (500 in {d for d, *_ in expected}) == within


def test_rows_without_an_id_and_rows_of_one_id_are_copies(spark):
    """Each of them is a document; the first row keeps, the others lose their text; names that clash stay."""
    one, two = prose(1, 60), prose(2, 60)
    docs = documents(spark, [(None, one), (None, one), (None, f"{one} {prose(3, 40)}"), (9, two), (9, two)]).withColumn("spans", F.lit(1))
    found = gear_chunks.repeated_spans(docs).collect()
    assert Counter(r["doc_id"] for r in found if r["is_keeper"]) == {None: 1, 9: 1}
    assert Counter(r["doc_id"] for r in found if not r["is_keeper"]) == {None: 2, 9: 1}
    left = gear_chunks.without_repeats(docs)
    texts = [r["text"] for r in left.collect()]
    assert left.columns == docs.columns and texts.count(two) == 1 and sum(t.startswith(one[:200]) for t in texts) == 1
