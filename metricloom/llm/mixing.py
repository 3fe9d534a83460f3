"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the mixture. Its mean repetition rate is
``share x size of the mixture / size of the source``; each text is repeated a
Poisson number of times with that mean, so shares hold in expectation without
any counting across texts, and a text's count does not depend on the others.
The number is drawn by inversion from a uniform that the seed and the text's
own key hash to, hence a rerun or a lost executor gives the same mixture. No
rate is too large: the partial sums start near the mean and end where what is
left is below what a uniform can tell. Copies are made in blocks, which are
dealt out first where a text can have many, and then shuffled over all
partitions by a hash.

Everything is DataFrame code. The table of rates has a row for each named
source and one for the rest, so broadcasting it is bounded by the parameter.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom.llm.common import stored

#: Target shares of the mixture; ``OTHERS`` share theirs in proportion to size.
WEIGHTS = {"src0": 0.2, "src1": 0.06, "src2": 0.06, "src3": 0.06}
OTHERS = "*"
SEED = "mix-1"
EPOCHS = 1.0  # size of the mixture, in sizes of the input
BLOCK = 1000  # copies made in one go
FROM_ZERO = 600.0  # largest mean whose partial sums start at no copy; exp(-mean) is a normal number
# For the query's SQL alone, which cuts rates and counts; up to this rate both give the same rows.
MOST = 60
MAX_RATE = 16.0


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) from the first 13 hex digits of an MD5."""
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), key).cast("binary")), 1, 13), 16, 10)
    return (digits.cast("double") + 0.5) / float(1 << 52)


def poisson(u: Column, mean: Column) -> Column:
    """Inverse of the Poisson distribution: how many partial sums lie below ``u``.

    Sums go from twelve standard deviations and 30 below the mean (from 0 for
    means up to ``FROM_ZERO``) to as far above it, about ``24 * sqrt(mean)``
    terms; less than 1e-16 of the distribution lies outside.
    """
    mean = mean.cast("double")
    spread = F.sqrt(mean) * 12 + 30
    low = F.when(mean <= FROM_ZERO, F.lit(0.0)).otherwise(F.floor(mean - spread).cast("double"))
    # Logarithm of the first term, by Stirling's series; ``low`` is 276 or more in it.
    at = F.greatest(low, F.lit(1.0))
    beyond = (mean - at) / at
    series = 1 / (at * 12) - 1 / (at * at * at * 360)
    first = F.when(low == 0, -mean).otherwise(
        at * (F.log1p(beyond) - beyond) - F.log(at * (2 * math.pi)) / 2 - series
    )
    # Columns go in by the state: one that only a lambda names is lost to the
    # optimizer when it moves a filter on the result below a join.
    own = [u.alias("u"), mean.alias("mean")]
    start = F.struct(F.exp(first).alias("p"), F.exp(first).alias("cdf"), low.cast("long").alias("n"), *own)
    return F.aggregate(
        F.sequence(low.cast("long") + 1, F.ceil(mean + spread).cast("long")),
        start,
        lambda s, k: F.when(s["cdf"] >= s["u"], s).otherwise(
            F.struct(
                (s["p"] * s["mean"] / k).alias("p"),
                (s["cdf"] + s["p"] * s["mean"] / k).alias("cdf"),
                k.alias("n"),
                s["u"].alias("u"),
                s["mean"].alias("mean"),
            )
        ),
        lambda s: s["n"],
    )


def copied(counted: DataFrame, deal: bool) -> DataFrame:
    """row, rate, key, copy: each row of ``counted`` as often as its ``n``, by blocks.

    With ``deal`` the blocks are spread over all tasks before they are filled,
    so no task makes all copies of a text.
    """
    size = F.lit(BLOCK).cast("long")
    blocks = counted.where("n > 0").select(
        "row", "rate", "key", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / size))).alias("block")
    )
    if deal:
        blocks = blocks.repartition("key", "block")
    begin = F.col("block") * size
    return blocks.select(
        "row", "rate", "key",
        F.explode(F.sequence((begin + 1).cast("int"), F.least(begin + size, F.col("n")).cast("int"))).alias("copy"),
    )


def rates(rows: DataFrame, weights: dict[str, float], others: float, epochs: float) -> DataFrame:
    """(group, rate): mean repetitions of a text of each named source and of the rest."""
    sizes = rows.groupBy("group").agg(F.sum("size").alias("size"))
    # A handful of rows, one for each weight.
    total = F.sum("size").over(Window.partitionBy(F.lit(0)))
    share = reduce(
        lambda out, item: out.when(F.col("group") == item[0], F.lit(float(item[1]))),
        weights.items(), F.when(F.col("group") == OTHERS, F.lit(float(others))),
    )
    present = sizes.withColumn("total", total)
    rate = share * F.col("total") * epochs / F.col("size")
    return present.select("group", rate.alias("rate"))


def mixed(
    docs: DataFrame, weights: dict[str, float] = WEIGHTS, seed: str = SEED, epochs: float = EPOCHS,
    carry: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """row, copy, rate and place of every copy in the mixture.

    Size is counted in UTF-8 bytes, a text of none counting as one byte.
    Sources without a weight, and texts without a source, share what the
    weights leave of 1. A source that the data lacks leaves its share unused.
    Rates have no limit; a text with more than 2^31 - 1 copies is an error. A
    text with a null id is drawn by its text. Repeated rows are drawn alike, each on its own. An empty table
    gives no row. ``row`` holds the columns ``carry`` (all by default).
    """
    if not all(w >= 0 for w in weights.values()) or sum(weights.values()) > 1 + 1e-9:
        raise ValueError("weights must not be negative nor exceed 1 in sum")
    columns = docs.columns if carry is None else carry
    source = F.col(source_col).cast("string")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.coalesce(F.col(id_col).cast("string"), F.md5(text.cast("binary"))).alias("key"),
        F.when(source.isin(list(weights)), source).otherwise(OTHERS).alias("group"),
        F.greatest(F.octet_length(text), F.lit(1)).cast("long").alias("size"),
    )
    found = stored(rates(rows, weights, max(0.0, 1 - sum(weights.values())), epochs), "rates")
    highest = found.agg(F.max("rate")).first()[0] or 0.0

    def drawn(some: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(some), "group").withColumn(
            "n", poisson(uniform(F.col("key"), seed), F.col("rate"))
        )

    if highest <= BLOCK:
        copies = copied(drawn(found), False)
    else:
        copies = copied(drawn(found.where(F.col("rate") <= BLOCK)), False).unionByName(
            copied(drawn(found.where(F.col("rate") > BLOCK)), True)
        )
    place = F.md5(F.concat_ws("|", F.lit(f"{seed}/order"), "key", F.col("copy").cast("string")).cast("binary"))
    return (
        copies.withColumn("place", place).drop("key")
        .repartition("place").sortWithinPartitions("place")
    )
