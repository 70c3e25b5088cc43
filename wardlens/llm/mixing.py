"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source with weight w and s bytes of text gets the mean repetition rate  w / W * S / s  over the sum W of the weights of the
sources with text and the bytes S of their documents: the expected bytes of the mix are again S, dealt by weight. Each document is
repeated k times, k being the inverse of the Poisson distribution of its rate at a number in (0, 1) that md5 draws
from the seed, its id and, where an id repeats, its text. A rate above ``CHUNK`` is a sum of equal smaller rates, each with
its own number, so that exp(-rate) never vanishes. The copies are then dealt to partitions by another md5 and
sorted by it there: a global shuffle without a sampling pass.

The rates are one row per source; each is repeated over ``SALTS`` salts, so that a source with a third of all
documents is joined in as many parts even where the rates are too many to be broadcast.

Cases: a null source is a source of its own; sources missing from given weights get weight 0 and drop out; sources without
any text have rate 0; null and empty texts count no bytes and are repeated like other documents of their source;
repeated rows draw the same number and are repeated alike; an empty table gives an empty result. The columns of the
input are kept by name; added columns are ``copy`` and ``shuffle_key``, prefixed by underscores if taken.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = "mix"
CHUNK = 16.0
TERMS = 96  # of the distribution function of a rate up to CHUNK; the rest is below 2^-53
SALTS = 32
DIGITS = 13  # hexadecimal digits of md5 that make a number: 52 bits


def uniform(text: Column) -> Column:
    """A number in (0, 1) drawn by md5."""
    drawn = F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("double")
    return (drawn + 0.5) / F.lit(float(16**DIGITS))


def poisson_inverse(rate: Column, number: Column) -> Column:
    """Smallest k at which the Poisson distribution function of ``rate`` (at most ``CHUNK``) reaches ``number``."""
    start = F.struct(
        F.lit(0).cast("long").alias("k"), F.exp(-rate).alias("p"), F.exp(-rate).alias("reached")
    )

    def step(state: Column, term: Column) -> Column:
        p = state["p"] * rate / term
        return F.when(
            state["reached"] < number,
            F.struct(term.cast("long").alias("k"), p.alias("p"), (state["reached"] + p).alias("reached")),
        ).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda state: state["k"])


def repetitions(rate: Column, name: Column) -> Column:
    """How often a document called ``name`` is repeated at a mean rate."""
    chunks = F.ceil(rate / CHUNK).cast("int")
    each = rate / F.greatest(chunks, F.lit(1))

    def drawn(i: Column) -> Column:
        return poisson_inverse(each, uniform(F.concat_ws("|", F.lit(SEED), i.cast("string"), name)))

    draws = F.transform(F.sequence(F.lit(1), F.greatest(chunks, F.lit(1))), drawn)
    total = F.aggregate(draws, F.lit(0).cast("long"), lambda a, b: a + b)
    return F.when(rate > 0, total).otherwise(F.lit(0).cast("long"))


def source_rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """(source, documents, bytes, rate) per source; equal weights unless given."""
    sizes = docs.groupBy(F.col("`source`").cast("string").alias("source")).agg(
        F.count("*").alias("documents"),
        F.sum(F.coalesce(F.octet_length(F.col("`text`")), F.lit(0)).cast("long")).alias("bytes"),
    )
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for source, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(value))).otherwise(weight)
    sizes = sizes.withColumn("weight", F.when(F.col("bytes") > 0, weight).otherwise(F.lit(0.0)))
    # One row per source; the totals over all of them are a one-row aggregate read as scalar subqueries.
    total = sizes.where("weight > 0").agg(F.sum("weight").alias("w"), F.sum("bytes").cast("double").alias("b"))
    scale = total.select((F.col("b") / F.col("w")).alias("scale")).scalar()
    rate = F.when(F.col("weight") > 0, F.col("weight") * scale / F.col("bytes")).otherwise(F.lit(0.0))
    return sizes.select("source", "documents", "bytes", rate.alias("rate"))


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name = "_" + name
    return name


def mix_sources(docs: DataFrame, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """Every copy of every document with the columns of ``docs``, ``copy`` (from 0) and ``shuffle_key``, shuffled."""
    names = docs.columns
    copy, key = _free("copy", names), _free("shuffle_key", names)
    rates = source_rates(docs, weights).select(
        F.col("source").alias("__source"), "rate", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")
    )
    name = F.concat_ws("|", F.col("`doc_id`").cast("string"), F.md5(F.col("`text`").cast("binary")))
    salted = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"),
        F.col("`source`").cast("string").alias("__of"),
        name.alias("__name"),
    ).withColumn("__part", F.pmod(F.xxhash64("__name"), F.lit(SALTS)).cast("int"))
    joined = salted.join(
        rates, F.col("__of").eqNullSafe(F.col("__source")) & (F.col("__part") == F.col("__salt"))
    )
    counted = joined.withColumn("__times", repetitions(F.col("rate"), F.col("__name"))).where("__times > 0")
    copies = counted.select(
        "__row", "__name", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__times") - 1)).alias("__copy")
    )
    keyed = copies.withColumn(
        "__key", F.md5(F.concat_ws("|", F.lit(SEED), F.lit("order"), F.col("__name"), F.col("__copy").cast("string")).cast("binary"))
    )
    shuffled = keyed.repartition("__key").sortWithinPartitions("__key")
    return shuffled.select(
        *[F.col("__row")[c].alias(c) for c in names], F.col("__copy").alias(copy), F.col("__key").alias(key)
    )


def mixed_documents(docs: DataFrame, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """The mix in the columns of ``docs``."""
    return mix_sources(docs, weights).select(*[F.col(f"`{c}`") for c in docs.columns])


def statement() -> str:
    """DuckDB statement of ``mix_sources`` with equal weights over ``documents``."""
    return f"""
WITH RECURSIVE sizes AS (
  SELECT source, sum(coalesce(octet_length(encode(text)), 0)) AS bytes FROM documents GROUP BY source
), scale AS (
  SELECT CAST(sum(bytes) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS scale FROM sizes WHERE bytes > 0
), rates AS (
  SELECT source, CASE WHEN bytes > 0 THEN 1.0::DOUBLE * scale / bytes ELSE 0.0 END AS rate FROM sizes, scale
), named AS (
  SELECT doc_id, d.source, text, rate, concat_ws('|', CAST(doc_id AS VARCHAR), md5(text)) AS name,
         greatest(CAST(ceil(rate / {CHUNK}) AS BIGINT), 1) AS chunks
  FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source WHERE rate > 0
), numbered AS (SELECT *, row_number() OVER () AS row_number FROM named
), drawn AS (
  SELECT row_number, rate / chunks AS each,
         (CAST('0x' || substr(md5(concat_ws('|', '{SEED}', CAST(i AS VARCHAR), name)), 1, {DIGITS}) AS BIGINT) + 0.5)
           / CAST({16**DIGITS} AS DOUBLE) AS number
  FROM (SELECT *, unnest(range(1, chunks + 1)) AS i FROM numbered)
), steps AS (
  SELECT row_number, number, each, CAST(0 AS BIGINT) AS k, exp(-each) AS p, exp(-each) AS reached FROM drawn
  UNION ALL
  SELECT row_number, number, each, k + 1, p * each / (k + 1), reached + p * each / (k + 1)
  FROM steps WHERE reached < number AND k < {TERMS}
), counts AS (
  SELECT row_number, sum(k) AS times FROM (
    SELECT row_number, number, max(k) AS k FROM steps GROUP BY row_number, number) GROUP BY row_number
)
SELECT doc_id, source, copy, text,
       md5(concat_ws('|', '{SEED}', 'order', name, CAST(copy AS VARCHAR))) AS shuffle_key
FROM (SELECT n.*, unnest(range(0, CAST(times AS BIGINT))) AS copy
      FROM numbered n JOIN counts c ON n.row_number = c.row_number)
"""
