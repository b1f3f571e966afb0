"""Association rules with single-item consequents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketweave.functions import lookup_join
from basketweave.workspace import Workspace


# A frequent item with its count, besides its name.
ITEM_BYTES = 200


def association_rules(
    itemsets: DataFrame,
    n: DataFrame,
    min_confidence: float = 0.0,
    lift: bool = False,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Rules from a complete frame of frequent itemsets ``(itemset, k, freq)``.

    Each member of an itemset of two or more is a consequent once, the others its
    antecedent. Both are themselves frequent, so inner joins find every count.
    `n` is the one-row frame of `transaction_count`.

    The itemsets are written to `workspace` once, as three sides of the joins read
    them. The commonest item is the consequent of most rules, and the antecedent of many, so
    counts are looked up by a broadcast, or by a join that splits hot keys.
    """
    ws = workspace or Workspace(itemsets.sparkSession)
    written = ws.write(
        "rule_itemsets",
        itemsets,
        singles=F.count_if(F.col("k") == 1),
        bytes=F.sum(F.octet_length(F.array_join("itemset", ","))),
    )
    itemsets = written.df
    total = n.select("n").scalar()
    wholes = (
        itemsets.filter("k > 1")
        .select("itemset", "freq", F.explode("itemset").alias("consequent"))
        .select("consequent", "freq", F.array_remove("itemset", F.col("consequent")).alias("antecedent"))
    )
    antecedents = itemsets.select(
        F.col("itemset").alias("antecedent"), F.col("freq").alias("antecedent_freq")
    )
    consequents = itemsets.filter("k = 1").select(
        F.element_at("itemset", 1).alias("consequent"), F.col("freq").alias("consequent_freq")
    )
    confidence = F.col("freq") / F.col("antecedent_freq")
    columns = [
        "antecedent",
        "consequent",
        (F.col("antecedent_freq") / total).alias("antecedent_support"),
        (F.col("consequent_freq") / total).alias("consequent_support"),
        (F.col("freq") / total).alias("support"),
        confidence.alias("confidence"),
    ]
    if lift:
        columns.append((confidence * total / F.col("consequent_freq")).alias("lift"))
    # A common item is the antecedent of very many rules, too.
    row_bytes = ITEM_BYTES + -(-written.stats["bytes"] // max(written.rows, 1))
    joined = lookup_join(
        wholes, antecedents, "antecedent", written.rows, row_bytes, ["consequent"]
    )
    return (
        lookup_join(
            joined, consequents, "consequent", written.stats["singles"], ITEM_BYTES, ["antecedent"]
        )
        .filter(confidence >= min_confidence)
        .select(*columns)
    )
