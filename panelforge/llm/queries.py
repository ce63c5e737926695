"""The registered queries of the corpus operators, with production parameters over whole tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelforge.llm import (
    cuckoo_dedup, gear_chunks, importance_resampling, license_join, pair_maxscore, proportional_shards, quality_hosts, quality_sql,
    sequence_files, simhash_tiles, template_leaks, temperature_mix, token_counts, toxic_automaton,
)
from panelforge.llm.common import read_table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_hosts.judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", *quality_hosts.MEASURES, "base_failed", "kept", "host_rate"
    ).transform(lambda df: df.selectExpr("*", "round(host_rate, 6) AS host_failure_rate").drop("host_rate"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_tiles.classes(read_table(spark, sf_dir, "documents"))


def op3_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temperature_mix.mixture(read_table(spark, sf_dir, "documents"))


def op4_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gear_chunks.repeated_spans(read_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op6_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_leaks.leaked_pairs(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), plain_names=True)


def op7_proportional_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proportional_shards.interleave(read_table(spark, sf_dir, "documents"))


def op8_toxic_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_automaton.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_sequence_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = sequence_files.write_sequences(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return sequence_files.read_sequences(manifest)


def op10_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.scan(read_table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_pair_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_maxscore.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo_dedup.groups(read_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_host_quality, op2_simhash, op3_temperature_mix, op4_gear_chunks, op5_token_counts, op6_template_leaks,
        op7_proportional_shards, op8_toxic_automaton, op9_sequence_files, op10_license_join, op11_importance_resampling, op12_pair_maxscore,
        op13_cuckoo_dedup,
    )
}

#: The others cannot be said in SQL (64-bit hashes of shingles, tokenizers, automata) and are tested against brute force.
ORACLES = {
    "op1_host_quality": quality_sql.sql(),
    "op3_temperature_mix": temperature_mix.sql(),
    "op7_proportional_shards": proportional_shards.sql(),
    "op10_license_join": license_join.sql(),
    "op11_importance_resampling": importance_resampling.sql(),
    "op12_pair_maxscore": pair_maxscore.sql(),
    "op13_cuckoo_dedup": cuckoo_dedup.sql(),
}
