"""Mixing sources to target weights, with DataFrame functions only.

A source that holds the share p of all tokens gets a weight proportional to p**a.  The exponent a in [0, 1] is the largest
one whose weights reach the target entropy, lowered no further than the repetition limit allows; it is found by bisection,
32 points a round, each round one aggregate over the table of sources.  The budget (by default the smallest that reads
every source once) gives each source a number of tokens.  They are realised as passes over the source: whole passes, then
a part of one.  Rows are hashed into blocks of bounded size; every pass takes the blocks in a seeded permutation of its
own and the rows of a block in another, and the last pass ends inside one block.  So running totals are taken over the
blocks of a source, in two levels, and within a block, never over the rows of a source.

Tokens of a row are its words and one end mark.  Defined results: NULL and empty texts have one token; NULL sources form
one source; rows with the same id and text share a block and are told apart by storage order only; an empty table gives an
empty table; extra columns are ignored, or passed on where named in ``carry``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm import common
from panelforge.llm.common import WORD_PATTERN, identified, key_of, seeded, sums_before, unit_fraction
from panelforge.storage import materialize

SEED = "mix-1"
ENTROPY_SHARE = 0.9
MAX_REPEATS = 2.0
BLOCK_ROWS = 512

_POINTS, _ROUNDS, _DIGITS = 32, 6, 6


def token_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    words = F.regexp_count(text, F.lit(WORD_PATTERN))
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").alias("source"),
        key_of(source_col).alias("source_key"),
        (F.coalesce(words, F.lit(0)) + 1).cast("long").alias("n_tokens"),
        # of id and text, so that rows without an id or with one id are shuffled as well
        seeded(seed, F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).alias("digest"),
        *carry,
    )


def source_shares(rows: DataFrame) -> DataFrame:
    """One row per source: tokens, rows, and the logarithm of its share."""
    totals = rows.groupBy("source_key").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_rows"))
    everything = totals.agg(F.sum("tokens").alias("t")).first()["t"] or 1
    return totals.withColumn("log_share", F.log(F.col("tokens") / F.lit(float(everything))))


def _weights_at(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For every exponent: the log of the normaliser and the entropy of the weights; one row reaches the driver."""
    sums = []
    for i, a in enumerate(exponents):
        power = F.exp(F.lit(a) * F.col("log_share"))
        sums += [F.sum(power).alias(f"z{i}"), F.sum(power * F.col("log_share")).alias(f"s{i}")]
    row = sources.agg(*sums).first()
    return [(math.log(row[f"z{i}"]), math.log(row[f"z{i}"]) - a * row[f"s{i}"] / row[f"z{i}"]) for i, a in enumerate(exponents)]


def find_exponent(sources: DataFrame, entropy_share: float | None = ENTROPY_SHARE, max_repeats: float | None = MAX_REPEATS, budget: float | None = None) -> float:
    """The exponent, rounded to six digits.  Entropy and the largest repetition both fall as the exponent rises."""
    facts = sources.agg(F.count("*").alias("k"), F.max("log_share").alias("hi"), F.min("log_share").alias("lo"), F.sum("tokens").alias("t")).first()
    if facts["k"] < 2:
        return 1.0
    over_all = math.log(budget / facts["t"]) if budget else None

    def search(fits, sums: bool = True) -> float:
        """The largest point of [0, 1] that fits, for a condition that fails from some point on."""

        def at(points: list[float]) -> list[tuple[float, float]]:
            return _weights_at(sources, points) if sums else [(0.0, 0.0)] * len(points)

        low, high = 0.0, 1.0
        if fits(1.0, *at([1.0])[0]):
            return 1.0
        for _ in range(_ROUNDS):
            points = [low + (high - low) * i / (_POINTS + 1) for i in range(1, _POINTS + 1)]
            good = [a for a, found in zip(points, at(points), strict=True) if fits(a, *found)]
            width = (high - low) / (_POINTS + 1)
            low = max(good, default=low)
            high = min(high, low + width)
        return low

    def repeats(a: float, log_z: float) -> float:
        """Log of the most passes over a source: over the smallest one, as a <= 1."""
        if over_all is None:
            return (facts["hi"] - facts["lo"]) * (1.0 - a)
        return over_all - log_z + (a - 1.0) * facts["lo"]

    exponent = 1.0
    if entropy_share is not None:
        target = entropy_share * math.log(facts["k"])
        exponent = search(lambda a, log_z, entropy: entropy >= target - 1e-12)
    if max_repeats is not None:
        limit = math.log(max_repeats)
        exponent = max(exponent, search(lambda a, log_z, entropy: repeats(a, log_z) > limit + 1e-12, over_all is not None))
    return round(exponent, _DIGITS)


def target_weights(sources: DataFrame, exponent: float, budget: float | None = None) -> DataFrame:
    """Weights, passes over each source, whole passes, and the tokens left for the last, partial pass."""
    raised = sources.withColumn("raised", F.exp(F.lit(exponent) * F.col("log_share")))
    facts = raised.agg(F.sum("raised").alias("z"), F.max("log_share").alias("hi"), F.sum("tokens").alias("t")).first()
    weighted = raised.withColumn("weight", F.round(F.col("raised") / F.lit(facts["z"] or 1.0), 6))
    if budget is None:
        passes = F.exp((F.lit(facts["hi"]) - F.col("log_share")) * F.lit(1.0 - exponent))
    else:
        passes = F.col("raised") / F.lit(facts["z"] or 1.0) * F.lit(float(budget)) / F.col("tokens")
    planned = weighted.withColumn("repeats", F.round(passes, 6))
    wanted = F.round(F.col("repeats") * F.col("tokens"), 0).cast("long")
    return planned.withColumn("wanted", wanted).selectExpr(
        "source_key", "weight", "repeats", "cast(wanted div tokens as int) AS whole", "wanted % tokens AS rest"
    )


def mixture(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    entropy_share: float | None = ENTROPY_SHARE,
    max_repeats: float | None = MAX_REPEATS,
    budget: float | None = None,
    seed: str = SEED,
    block_rows: int = BLOCK_ROWS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row for every time a document is drawn: its pass, block, the block's place in the pass and the row's in it."""
    rows = materialize(token_rows(docs, id_col, text_col, source_col, seed, carry), "mix-rows")
    n_blocks = max(1, math.ceil(rows.count() / block_rows))
    rows = rows.withColumn("block", F.floor(unit_fraction(F.col("digest")) * F.lit(n_blocks)).cast("long"))
    blocks = materialize(rows.groupBy("source_key", "block").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_rows")), "mix-blocks")
    sources = materialize(source_shares(blocks.withColumnRenamed("tokens", "n_tokens")), "mix-sources")
    exponent = find_exponent(sources, entropy_share, max_repeats, budget)
    weights = target_weights(sources, exponent, budget)

    last = F.col("whole") + F.when(F.col("rest") > 0, 0).otherwise(-1)
    passes = blocks.join(weights, "source_key").where(last >= 0)
    passes = passes.withColumn("pass", F.explode(F.sequence(F.lit(0), last)))
    placed = passes.withColumn("block_digest", seeded(seed, "block", F.col("pass"), F.col("source_key"), F.col("block")))
    part = F.floor(unit_fraction(F.col("block_digest")) * F.lit(math.ceil(n_blocks / common.PART_ROWS)))
    placed = sums_before(placed, ["source_key", "pass"], part, ["block_digest", "block"], block_rank=F.lit(1), before=F.col("tokens"))
    placed = placed.withColumn("block_rank", F.col("block_rank") + 1)
    room = F.when(F.col("pass") < F.col("whole"), F.col("tokens")).otherwise(F.col("rest") - F.col("before"))
    taken = placed.withColumn("room", room).where("room > 0").select("source_key", "block", "pass", "block_rank", "room", "weight", "repeats")

    inner = Window.partitionBy("source_key", "block", "pass").orderBy("row_digest", "doc_id", "n_tokens")
    drawn = rows.join(taken, ["source_key", "block"])
    drawn = drawn.withColumn("row_digest", seeded(seed, "row", F.col("pass"), F.col("digest")))
    drawn = drawn.withColumns(
        {
            "in_block": F.row_number().over(inner).cast("long"),
            "start": F.coalesce(F.sum("n_tokens").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        }
    )
    columns = ["doc_id", "source", "pass", "block", "block_rank", "in_block", "n_tokens", "weight", "repeats", *carry]
    return drawn.where("start < room").select(*columns)


def realise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """``docs`` with every row as often as the mixture draws it."""
    columns = docs.columns
    marked, row = identified(docs)
    # drawn under a name of its own, since ``docs`` may have columns called like those of the mixture
    narrow = marked.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{source_col}`").alias("source"), F.col(row).alias("place"))
    copies = mixture(narrow, carry=("place",), **settings).groupBy("place").agg(F.count("*").cast("int").alias("copies"))
    copies = copies.select(F.col("place").alias(row), F.array_repeat(F.lit(0), F.col("copies")).alias(f"{row}_copies"))
    joined = marked.join(copies, row)
    return joined.select(*(F.col(f"`{c}`") for c in columns), F.explode(f"{row}_copies").alias(f"{row}_copy")).drop(f"{row}_copy")


def sql(seed: str = SEED, entropy_share: float = ENTROPY_SHARE, max_repeats: float = MAX_REPEATS, block_rows: int = BLOCK_ROWS) -> str:
    """DuckDB text for ``mixture`` over ``documents`` with the default budget."""
    return f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS source_key,
         coalesce(len(regexp_extract_all(text, '{WORD_PATTERN}')), 0) + 1 AS n_tokens,
         md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS digest
  FROM documents),
cut AS (SELECT *, floor(('0x' || substr(digest, 1, 13))::BIGINT / 4503599627370496.0::DOUBLE * greatest(1, ceil((SELECT count(*) FROM rows) / {block_rows}.0)))::BIGINT AS block FROM rows),
shares AS (SELECT source_key, sum(n_tokens)::BIGINT AS tokens, ln(sum(n_tokens)::DOUBLE / (SELECT sum(n_tokens) FROM rows)) AS log_share FROM rows GROUP BY 1),
facts AS (SELECT count(*) AS k, max(log_share) AS hi, min(log_share) AS lo FROM shares),
halves(i, low_e, high_e, low_r, high_r) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1,
    CASE WHEN fits_e THEN mid_e ELSE low_e END, CASE WHEN fits_e THEN high_e ELSE mid_e END,
    CASE WHEN fits_r THEN mid_r ELSE low_r END, CASE WHEN fits_r THEN high_r ELSE mid_r END
  FROM (SELECT *,
      (SELECT ln(sum(exp(mid_e * log_share))) - mid_e * sum(exp(mid_e * log_share) * log_share) / sum(exp(mid_e * log_share)) FROM shares)
        >= {entropy_share} * ln((SELECT k FROM facts)) - 1e-12 AS fits_e,
      (SELECT (hi - lo) * (1.0 - mid_r) FROM facts) > ln({max_repeats}) + 1e-12 AS fits_r
    FROM (SELECT *, CASE WHEN i = 0 THEN 1.0 ELSE (low_e + high_e) / 2 END AS mid_e, CASE WHEN i = 0 THEN 1.0 ELSE (low_r + high_r) / 2 END AS mid_r FROM halves WHERE i < 45) t) t),
chosen AS (SELECT CASE WHEN (SELECT k FROM facts) < 2 THEN 1.0 ELSE round(greatest(low_e, low_r), 6) END AS a FROM halves WHERE i = 45),
weights AS (
  SELECT source_key, tokens, round(exp(a * log_share) / (SELECT sum(exp(a * log_share)) FROM shares, chosen), 6) AS weight,
         round(exp(((SELECT hi FROM facts) - log_share) * (1.0 - a)), 6) AS repeats
  FROM shares, chosen),
planned AS (SELECT *, round(repeats * tokens)::BIGINT // tokens AS whole, round(repeats * tokens)::BIGINT % tokens AS rest FROM weights),
blocks AS (SELECT source_key, block, sum(n_tokens)::BIGINT AS tokens FROM cut GROUP BY ALL),
passes AS (SELECT b.*, p.weight, p.repeats, p.whole, p.rest, unnest(generate_series(0, p.whole + CASE WHEN p.rest > 0 THEN 0 ELSE -1 END)) AS pass
  FROM blocks b JOIN planned p USING (source_key)),
placed AS (SELECT *, row_number() OVER w AS block_rank, coalesce(sum(tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM passes WINDOW w AS (PARTITION BY source_key, pass ORDER BY md5('{seed}:block:' || pass || ':' || source_key || ':' || block), block)),
taken AS (SELECT *, CASE WHEN pass < whole THEN tokens ELSE rest - before END AS room FROM placed),
drawn AS (SELECT c.doc_id, c.source, t.pass, c.block, t.block_rank, c.n_tokens, t.weight, t.repeats, t.room, row_number() OVER w AS in_block,
         coalesce(sum(c.n_tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM cut c JOIN taken t USING (source_key, block) WHERE t.room > 0
  WINDOW w AS (PARTITION BY source_key, block, pass ORDER BY md5('{seed}:row:' || pass || ':' || c.digest), c.doc_id NULLS FIRST, c.n_tokens))
SELECT doc_id, source, pass::INTEGER AS pass, block, block_rank, in_block, n_tokens::BIGINT AS n_tokens, weight, repeats FROM drawn WHERE start < room
"""
