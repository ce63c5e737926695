import math
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from panelforge.llm import common, proportional_shards, temperature_mix
from tests.llm.frames import awkward_documents, documents, empty_documents
from tests.llm.twins import against_sql


def sourced(spark, sizes, words=4):
    rows, at = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((at, " ".join(f"t{at}" for _ in range(words)), source))
            at += 1
    return documents(spark, rows)


def entropy(weights):
    return -sum(w * math.log(w) for w in weights)


def test_weights_meet_the_target_entropy(spark):
    docs = sourced(spark, {"a": 400, "b": 60, "c": 30, "d": 10})
    sources = temperature_mix.source_shares(temperature_mix.token_rows(docs, "doc_id", "text", "source"))
    exponent = temperature_mix.find_exponent(sources, 0.8, None)
    weights = [r["weight"] for r in temperature_mix.target_weights(sources, exponent).collect()]
    assert abs(entropy(weights) - 0.8 * math.log(4)) < 1e-4 and abs(sum(weights) - 1) < 1e-5
    assert temperature_mix.find_exponent(sources, 0.1, None) == 1.0  # already more even than asked for


def test_repetition_limit_wins(spark):
    docs = sourced(spark, {"a": 400, "b": 60, "c": 30, "d": 10})
    found = temperature_mix.mixture(docs, entropy_share=0.99, max_repeats=2.0, block_rows=16)
    assert abs(max(r["repeats"] for r in found.collect()) - 2.0) < 1e-3


@pytest.mark.parametrize("block_rows", [8])
def test_tokens_drawn_follow_the_weights_and_nothing_is_lost(spark, block_rows):
    docs = sourced(spark, {"a": 300, "b": 90, "c": 33})
    rows = temperature_mix.mixture(docs, entropy_share=0.95, max_repeats=3.0, block_rows=block_rows).collect()
    drawn, wanted = Counter(), {}
    for r in rows:
        drawn[r["source"]] += r["n_tokens"]
        wanted[r["source"]] = r["repeats"] * {"a": 300, "b": 90, "c": 33}[r["source"]] * 5
    assert all(0 <= drawn[s] - wanted[s] <= 5.5 for s in wanted)  # one document beyond at most
    assert {r["doc_id"] for r in rows} == set(range(423))
    assert max(Counter((r["doc_id"], r["pass"]) for r in rows).values()) == 1
    places = Counter((r["source"], r["pass"], r["block_rank"], r["in_block"]) for r in rows)
    assert max(places.values()) == 1
    whole = {(r["source"], r["pass"]): [] for r in rows}
    for r in rows:
        whole[r["source"], r["pass"]].append((r["block_rank"], r["block"]))
    first, second = (sorted(set(whole["c", p])) for p in (0, 1))
    assert len(first) == 1 or [b for _, b in first][: len(second)] != [b for _, b in second]  # each pass in an order of its own


def test_a_budget_below_the_whole_samples(spark):
    docs = sourced(spark, {"a": 300, "b": 100})
    rows = temperature_mix.mixture(docs, entropy_share=1.0, max_repeats=None, budget=500.0, block_rows=16).collect()
    drawn = Counter()
    for r in rows:
        drawn[r["source"]] += r["n_tokens"]
    assert drawn == {"a": 250, "b": 250}


def test_mixture_against_sql(spark):
    against_sql(awkward_documents(spark), lambda docs: temperature_mix.mixture(docs, block_rows=4), temperature_mix.sql(block_rows=4))


def test_realise_repeats_whole_rows(spark):
    docs = awkward_documents(spark)
    found = temperature_mix.realise(docs, block_rows=4)
    assert found.columns == docs.columns
    kept, given = Counter(map(tuple, found.collect())), Counter(map(tuple, docs.collect()))
    assert set(kept) == set(given) and all(kept[k] >= given[k] for k in given)
    assert sum(kept.values()) == temperature_mix.mixture(docs, block_rows=4).count()


def test_one_source_is_drawn_once(spark):
    assert temperature_mix.mixture(sourced(spark, {"a": 50})).count() == 50


def test_empty_tables(spark):
    empty = empty_documents(spark)
    assert temperature_mix.mixture(empty).count() == 0
    assert temperature_mix.realise(empty).count() == 0
    assert proportional_shards.interleave(empty).count() == 0
    assert proportional_shards.sharded_documents(empty).count() == 0


@pytest.mark.parametrize("range_rows", [5, 1024])
def test_every_shard_matches_the_mixture(spark, range_rows):
    sizes = {"a": 500, "b": 120, "c": 64, "d": 9}
    total = sum(sizes.values())
    rows = proportional_shards.sharded_documents(sourced(spark, sizes).drop("shard"), range_rows=range_rows).collect()
    per_shard = Counter(r["shard"] for r in rows)
    assert len(rows) == total and max(per_shard.values()) - min(per_shard.values()) <= 1 and len(per_shard) == 8
    for shard in per_shard:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(per_shard[shard]))
    for source, n in sizes.items():
        shares = Counter(r["shard"] for r in rows if r["source"] == source)
        assert all(abs(shares[s] - n / 8) <= 2 for s in range(8))


@pytest.mark.parametrize("range_rows", [7, 1024])
def test_sources_of_one_row_are_spread(spark, range_rows):
    docs = sourced(spark, {"big": 2000} | {f"single{i}": 1 for i in range(400)} | {f"pair{i}": 2 for i in range(40)})
    rows = proportional_shards.sharded_documents(docs.drop("shard"), range_rows=range_rows).select("source", "shard").collect()
    for kind, n in {"big": 2000, "single": 400, "pair": 80}.items():
        shares = Counter(r["shard"] for r in rows if r["source"].startswith(kind))
        assert all(abs(shares[s] - n / 8) <= 2 for s in range(8)), kind


def test_rows_without_an_id_are_spread_over_ranges(spark):
    docs = documents(spark, [(None, f"text {i}", "a") for i in range(900)])
    digests = docs.select(proportional_shards.seeded("s", F.lit("null"), F.crc32(F.col("text").cast("binary"))).alias("d"))
    assert digests.distinct().count() == 900
    rows = proportional_shards.interleave(docs, range_rows=10).select("shard", "slot").collect()
    assert len(rows) == 900 and len(set(map(tuple, rows))) == 900


@pytest.mark.parametrize("range_rows", [3, 1024])
def test_shards_against_sql(spark, range_rows):
    docs = awkward_documents(spark).where("doc_id <= 6 OR doc_id >= 9 OR doc_id IS NULL")  # the checksum in SQL is slow on long texts
    against_sql(docs, lambda d: proportional_shards.interleave(d, range_rows=range_rows), proportional_shards.sql())


def test_sizes_and_checksums(spark):
    docs = awkward_documents(spark)
    given = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, crc32((r["text"] or "").encode())) for r in docs.collect())
    found = proportional_shards.interleave(docs).select("doc_id", "size", "text_crc32").collect()
    assert Counter(map(tuple, found)) == given


def test_sharding_keeps_clashing_columns(spark):
    docs = awkward_documents(spark)
    found = proportional_shards.sharded_documents(docs)
    assert found.columns == [*docs.columns, "_shard", "slot"]
    assert found.select(F.countDistinct("_shard")).first()[0] == 8


def test_rows_without_an_id_are_mixed_in_blocks(spark):
    docs = documents(spark, [(None, f"text {i}", "a") for i in range(600)])
    blocks = Counter(r["block"] for r in temperature_mix.mixture(docs, block_rows=20).collect())
    assert sum(blocks.values()) == 600 and len(blocks) == 30 and max(blocks.values()) <= 45


@pytest.mark.parametrize("by", [[], ["g"]])
def test_sums_in_two_levels_against_a_plain_window(spark, by):
    rows = spark.range(500).selectExpr("cast(id * 37 % 500 as bigint) AS at", "id % 3 = 0 AS g", "id % 7 AS v", "id AS upper")
    found = common.sums_before(rows, by, F.floor(F.col("at") / 9), ["at"], total=F.col("v"), place=F.lit(1))
    assert found.columns == [*rows.columns, "total", "place", "total_all", "place_all"]
    groups = {}
    for r in sorted(found.collect(), key=lambda r: r["at"]):
        before = groups.setdefault(r["g"] if by else None, [])
        assert (r["total"], r["place"]) == (sum(before), len(before))
        before.append(r["v"])
    for r in found.collect():
        whole = groups[r["g"] if by else None]
        assert (r["total_all"], r["place_all"]) == (sum(whole), len(whole))
    assert common.sums_before(rows.limit(0), by, F.floor(F.col("at") / 9), ["at"], total=F.col("v")).count() == 0


def test_parts_of_running_sums_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(common, "PART_ROWS", 2)
    docs = awkward_documents(spark).where("doc_id <= 6 OR doc_id >= 9 OR doc_id IS NULL").unionByName(sourced(spark, {"a": 90, "b": 30, "c": 1, "d": 1}))
    against_sql(docs, lambda d: proportional_shards.interleave(d, range_rows=3), proportional_shards.sql())
    against_sql(docs, lambda d: temperature_mix.mixture(d, block_rows=4), temperature_mix.sql(block_rows=4))
