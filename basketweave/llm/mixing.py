"""Mixing sources to target weights by temperature.

The token shares `p` of the sources are raised to an exponent `a` and normalised:
1 keeps the natural shares, 0 makes all sources equal. Bisection finds the exponent that
meets a target entropy or a limit on repetition. A token budget then gives each source
a quota, and the source is read epoch by epoch, each time in another permutation of its
blocks, until the quota is used up.

No source is ever sorted as a whole. Its documents are dealt into blocks of a bounded
size by a hash; running totals are taken within a block, over the blocks of a group and
over the groups of a source, and added.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketweave.llm.common import words
from basketweave.workspace import Workspace

# Documents in a block, and blocks in a group, on average.
BLOCK_DOCS = 1024
GROUP_BLOCKS = 1024
# Each round splits the interval of the exponent so many times: five bisections at once.
SPLITS = 32
ROUNDS = 6
SEED = "mix"


def fraction(*parts: Column | str) -> Column:
    """A number from 0 to 2^32 - 1 from the MD5 of `parts`, joined by bars."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")


def exponent(
    sources: DataFrame,
    target_entropy: float | None,
    max_repeats: float | None,
    keep_all: bool = False,
) -> float:
    """The exponent for the token counts ``_total`` of `sources`, to 2^-30.

    It is the largest at which the entropy of the weights reaches `target_entropy`, a
    share of the greatest one; if that repeats a source more than `max_repeats` times,
    it is the smallest that does not. Without a target, the limit alone decides;
    without either it is 1. One row per trial value comes to the driver.
    """
    if target_entropy is None and max_repeats is None:
        return 1.0
    low, high = 0.0, 1.0
    totals = sources.where("_total > 0").select("_total")
    whole, n = totals.agg(F.sum("_total"), F.count(F.lit(1))).first()
    if not n:
        return 1.0
    shares = totals.select((F.col("_total") / F.lit(whole)).alias("p"))
    for _ in range(ROUNDS):
        step = (high - low) / SPLITS
        trials = F.array(*[F.lit(low + step * i) for i in range(1, SPLITS)])
        raised = shares.select("*", F.explode(trials).alias("a")).withColumn(
            "w", F.pow("p", F.col("a"))
        )
        rows = (
            raised.groupBy("a")
            .agg(
                F.sum("w").alias("z"),
                F.sum(F.col("w") * F.log("p")).alias("s"),
                F.max(F.col("w") / F.col("p")).alias("most"),
                F.min(F.col("w") / F.col("p")).alias("least"),
            )
            .select(
                "a",
                (F.log("z") - F.col("a") * F.col("s") / F.col("z")).alias("entropy"),
                (F.col("most") / F.col("least" if keep_all else "z")).alias("repeats"),
            )
            .collect()
        )
        for row in sorted(rows):
            over = max_repeats is not None and row["repeats"] > max_repeats
            flat = (
                target_entropy is not None
                and row["entropy"] >= target_entropy * log(n)
            )
            if not (over or flat):
                high = row["a"]
                break
            low = row["a"]
    return high


def _prefix(df: DataFrame, by: list[str], order: list[str], value: str, name: str) -> DataFrame:
    window = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumn(name, F.sum(value).over(window) - F.col(value))


def mix(
    docs: DataFrame,
    ws: Workspace,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: int | str = "total",
    seed: str = SEED,
) -> DataFrame:
    """One row for each time that a document is read in the mixture.

    `docs` has ``doc_id``, ``text`` and ``source``; all its columns stay. Added are
    ``mix_tokens`` (words of the text), ``mix_epoch`` (from 0) and ``mix_position``
    (from 0 to 1, the share of its source's quota that is read before); ordering the
    rows by it interleaves the sources. `budget` is a number of tokens, "total" for as
    many as there are, or "keep" for the fewest at which every document is read at
    least once. A document is read if it begins within the quota (without words, also at
    its end), so a source exceeds its quota by less than a document.

    A null source is a source of its own. Documents without words use no quota; a
    source without any words is read once. Repeated rows count each. An empty table
    gives an empty frame. Columns with the added names are replaced.
    """
    kept = [c for c in docs.columns if c not in ("mix_tokens", "mix_epoch", "mix_position")]
    source = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
        F.size(words(F.col("text").cast("string"))).cast("bigint").alias("mix_tokens"),
        source.alias("_source"),
    )
    # Rows without an id are told apart by their texts, so they do not share one block.
    named = F.coalesce(
        F.col("_row.doc_id").cast("string"), F.xxhash64(F.col("_row.text").cast("string")).cast("string")
    )
    rows = rows.withColumn("_key", F.concat_ws("|", named, "mix_tokens"))
    sizes = rows.groupBy("_source").agg(
        F.sum("mix_tokens").alias("_total"), F.count(F.lit(1)).alias("_docs")
    )
    sources = ws.write("sources", sizes).df
    a = exponent(sources, target_entropy, max_repeats, budget == "keep")
    quotas = ws.write("quotas", _quotas(sources, a, budget)).df

    placed = (
        rows.join(quotas, "_source")
        .withColumn("_block", F.pmod(fraction(F.lit(seed), "_key"), F.col("_blocks")))
        .withColumn("_group", F.pmod(F.col("_block"), F.col("_groups")))
    )
    blocks = (
        placed.groupBy("_source", "_group", "_block", "_epochs")
        .agg(F.sum("mix_tokens").alias("_sum"))
        .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_epochs") - 1)))
        .withColumn("_order", F.md5(F.concat_ws("|", F.lit(seed), "_source", "mix_epoch", "_block")))
    )
    blocks = ws.write("blocks", blocks).df
    groups = (
        blocks.groupBy("_source", "mix_epoch", "_group")
        .agg(F.sum("_sum").alias("_group_sum"))
        .withColumn(
            "_group_order", F.md5(F.concat_ws("|", F.lit(seed), "_source", "mix_epoch", "_group"))
        )
    )
    epoch = ["_source", "mix_epoch"]
    groups = _prefix(groups, epoch, ["_group_order", "_group"], "_group_sum", "_before_group")
    blocks = _prefix(blocks, [*epoch, "_group"], ["_order", "_block"], "_sum", "_before_block")
    starts = blocks.join(groups, [*epoch, "_group"]).select(
        *epoch, "_block", (F.col("_before_group") + F.col("_before_block")).alias("_start")
    )
    # Blocks of the last epoch that begin beyond the quota go before documents are joined.
    starts = (
        starts.join(quotas.select("_source", "_total", "_quota"), "_source")
        .withColumn("_start", F.col("_start") + F.col("mix_epoch") * F.col("_total"))
        .where("_start <= _quota")
        .drop("_total")
    )
    read = placed.drop("_quota", "_total").join(starts, ["_source", "_block"]).withColumn(
        "_order", F.md5(F.concat_ws("|", F.lit(seed), "mix_epoch", "_key"))
    )
    read = _prefix(read, [*epoch, "_block"], ["_order", "_key"], "mix_tokens", "_within")
    at = F.col("_start") + F.col("_within")
    return (
        read.where((at < F.col("_quota")) | (F.col("mix_tokens") == 0) & (at == F.col("_quota")))
        .withColumn("mix_position", F.when(F.col("_quota") > 0, at / F.col("_quota")).otherwise(0.0))
        .select("_row.*", "mix_tokens", "mix_epoch", "mix_position")
    )


def _quotas(sources: DataFrame, a: float, budget: int | str) -> DataFrame:
    """Per source its quota of tokens, epochs, blocks and groups of blocks."""
    whole = sources.agg(F.sum("_total")).first()[0] or 0
    raised = sources.withColumn(
        "_raised",
        F.when(F.col("_total") > 0, F.pow(F.col("_total") / F.lit(whole), F.lit(a))).otherwise(0.0),
    )
    norm, least = raised.agg(
        F.sum("_raised"),
        F.min(F.when(F.col("_total") > 0, F.col("_raised") / F.col("_total"))),
    ).first()
    if budget == "keep":  # the least repeated source is read once
        quota = F.greatest(
            F.round(F.col("_raised") / F.lit(least or 1.0)).cast("bigint"), F.col("_total")
        )
    else:
        tokens = whole if budget == "total" else int(budget)
        quota = F.round(F.col("_raised") / F.lit(norm or 1.0) * F.lit(tokens))
    blocks = F.ceil(F.col("_docs") / BLOCK_DOCS)
    return raised.select(
        "_source",
        "_total",
        quota.cast("bigint").alias("_quota"),
        F.when(F.col("_total") > 0, F.greatest(F.ceil(quota / F.col("_total")), F.lit(1)))
        .otherwise(1)
        .cast("bigint")
        .alias("_epochs"),
        blocks.cast("bigint").alias("_blocks"),
        F.ceil(blocks / GROUP_BLOCKS).cast("bigint").alias("_groups"),
    )
