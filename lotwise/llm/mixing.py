"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.tables import checkpointed, look_up

#: Up to so many sources, the table of their rates (about 1 KB each) is broadcast.
BROADCAST_SOURCES = 100_000
#: Up to this rate a source's Poisson distribution is made once (115 numbers at most); above it each row counts its own
#: number, which takes time in proportion to the copies that it gives.
TABLED_RATE = 25.0
#: Hexadecimal digits of a hash that make a uniform number: 52 bits, exact in a double.
DIGITS = 13


def _hashed(*parts: Column) -> Column:
    """Whole number of DIGITS hexadecimal digits from the MD5 of the parts."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long")


def source_rates(
    docs: DataFrame, weights: Mapping[str, float], default_weight: float, size: int | None, source_col: str = "source"
) -> DataFrame:
    """(mix_source, n, rate, cdf): documents and mean repetitions of a document of each source, and the Poisson distribution of that mean
    (null above TABLED_RATE).

    The rate is weight / sum of weights * size / documents of the source; ``size`` is that of the input if not given.
    Only sources that occur share the weights. A null source is a source of its own.
    """
    counts = docs.groupBy(F.coalesce(F.col(source_col).cast("string"), F.lit("\u0000")).alias("mix_source")).agg(
        F.count("*").alias("n")
    )
    weight = F.lit(float(default_weight))
    if weights:
        listed = F.create_map(*[x for k, v in sorted(weights.items()) for x in (F.lit(k), F.lit(float(v)))])
        weight = F.coalesce(listed[F.col("mix_source")], weight)
    counts = counts.withColumn("weight", weight)
    total, rows = counts.agg(F.sum("weight"), F.sum("n")).first()
    rate = F.col("weight") / F.lit(float(total or 1)) * F.lit(float(rows or 0) if size is None else float(size)) / F.col("n")
    return counts.select("mix_source", "n", rate.alias("rate")).withColumn(
        "cdf", F.when(F.col("rate") <= TABLED_RATE, poisson_cdf(F.col("rate")))
    )


def _rated(rows: DataFrame, rates: DataFrame) -> DataFrame:
    if rates.count() <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(rates), "mix_source")
    return look_up(rows, rates, "mix_source", "n")


def _last(rate: Column) -> Column:
    """From here on P(X <= k) is 1 in double precision."""
    return F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")


def poisson_cdf(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... up to where it is 1 in double precision. Terms are made from logarithms, so that
    large means don't underflow. A mean of 0 gives [1.0]."""
    ks = F.sequence(F.lit(1), _last(rate))
    zero = F.struct(F.lit(0.0).alias("log_fact"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("all"))

    def step(acc: Column, k: Column) -> Column:
        log_fact = acc["log_fact"] + F.log(k.cast("double"))
        total = acc["sum"] + F.exp(k * F.log(rate) - rate - log_fact)
        return F.struct(log_fact.alias("log_fact"), total.alias("sum"), F.concat(acc["all"], F.array(total)).alias("all"))

    return F.when(rate > 0, F.aggregate(ks, zero, step, lambda acc: acc["all"])).otherwise(F.array(F.lit(1.0)))


def copies_of(cdf: Column, uniform: Column) -> Column:
    """The Poisson number whose share of [0, 1) holds ``uniform``."""
    return F.size(F.filter(cdf, lambda c: c <= uniform))


def poisson_number(rate: Column, uniform: Column) -> Column:
    """``copies_of(poisson_cdf(rate), uniform)`` for a mean above 0, from the same terms without holding them."""
    below = lambda total: F.when(total <= uniform, 1).otherwise(0)
    zero = F.struct(F.lit(0.0).alias("log_fact"), F.exp(-rate).alias("sum"), below(F.exp(-rate)).alias("n"))

    def step(acc: Column, k: Column) -> Column:
        log_fact = acc["log_fact"] + F.log(k.cast("double"))
        total = acc["sum"] + F.exp(k * F.log(rate) - rate - log_fact)
        return F.struct(log_fact.alias("log_fact"), total.alias("sum"), (acc["n"] + below(total)).alias("n"))

    return F.aggregate(F.sequence(F.lit(1), _last(rate)), zero, step, lambda acc: acc["n"])


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float],
    default_weight: float = 1.0,
    size: int | None = None,
    seed: int = 0,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """Columns of ``docs`` plus copy_no (from 1) and mix_key, each document as often as its Poisson number says.

    The number follows from the document's id and the seed alone, so a rerun or a lost executor changes nothing;
    rows with equal ids get equal numbers. Copies are dealt to partitions and ordered by mix_key, a hash of seed,
    id and copy number: a shuffle of all rows. Sources of weight 0 go. Null ids and null sources are values like
    any other. Input columns named copy_no or mix_key are replaced. An empty table gives an empty result.
    """
    rates = checkpointed(source_rates(docs, weights, default_weight, size, source_col))
    keep = [c for c in docs.columns if c not in ("copy_no", "mix_key")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"))
    doc_id, source = F.col("doc")[id_col], F.coalesce(F.col("doc")[source_col].cast("string"), F.lit("\u0000"))
    uniform = _hashed(F.lit(seed), doc_id) / F.lit(float(16**DIGITS))
    tabled = F.col("cdf").isNotNull()
    copies = F.when(tabled, copies_of(F.col("cdf"), uniform)).otherwise(poisson_number(F.col("rate"), uniform))
    numbered = (
        _rated(rows.withColumn("mix_source", source), rates)
        .select("doc", copies.alias("copies"))
        .filter("copies > 0")
        .select("doc", F.explode(F.expr("sequence(1, copies)")).alias("copy_no"))
        .withColumn("mix_key", _hashed(F.lit(seed), F.col("doc")[id_col], F.col("copy_no")))
    )
    return numbered.repartition("mix_key").sortWithinPartitions("mix_key").select("doc.*", F.col("copy_no").cast("long"), "mix_key")
