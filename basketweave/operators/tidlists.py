"""Vertical layout: which transactions hold an itemset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketweave.functions import lookup_join, once
from basketweave.operators.counting import frequent_lookup, keep_frequent
from basketweave.sources.transactions import long_rows
from basketweave.workspace import Workspace

# Transactions per bucket, on average: the length limit of one tid array.
BUCKET_TIDS = 131_072
# Smaller buckets are used down to this size while there are fewer than tasks.
SMALL_BUCKET_TIDS = 8_192
# Lists of one stem that are intersected with each other in one place.
CLASS_LISTS = 512


def bucket_count(transactions: int, tasks: int) -> int:
    """Enough buckets to bound the arrays, and to give every task some."""
    bounded = -(-transactions // BUCKET_TIDS)
    return max(1, bounded, min(tasks, -(-transactions // SMALL_BUCKET_TIDS)))


def tid_lists(
    data: DataFrame, min_support: int, buckets: int | None = None, workspace: Workspace | None = None
) -> DataFrame:
    """Per frequent item its transactions: ``(itemset, bucket, tids)``.

    Tids are spread over `buckets` by hash, so the list of a very common item is
    `buckets` short arrays; by default there are as many as the commonest item needs.
    The threshold is on the sum over all buckets.
    """
    rows = long_rows(data)
    frequent = frequent_lookup(workspace or Workspace(data.sparkSession), rows, min_support)
    if buckets is None:
        buckets = max(1, -(-frequent.stats["most"] // BUCKET_TIDS))
    return bucketed_lists(keep_frequent(rows, frequent), buckets)


def bucketed_lists(rows: DataFrame, buckets: int) -> DataFrame:
    """Distinct ``(tid, item)`` rows as tid arrays per item and bucket."""
    bucket = F.pmod(F.xxhash64("tid"), F.lit(buckets)).cast("int")
    return (
        rows.groupBy(F.array("item").alias("itemset"), bucket.alias("bucket"))
        .agg(F.collect_list("tid").alias("tids"))
    )


def intersect_tid_lists(
    lists: DataFrame,
    candidates: DataFrame,
    candidate_rows: int | None = None,
    k: int = 2,
    spread_lists: DataFrame | None = None,
) -> DataFrame:
    """Tid lists of `candidates` from those of their two parents.

    The parents of a k-itemset are the itemset without its last and without its
    last but one item; both lists together hold exactly its transactions.
    `spread_lists` is `lists` over more tasks, to share out the intersections.
    """
    parents = candidates.select(
        "itemset",
        F.expr("slice(itemset, 1, size(itemset) - 1)").alias("left"),
        F.expr(
            "concat(slice(itemset, 1, size(itemset) - 2), array(element_at(itemset, -1)))"
        ).alias("right"),
    )
    first = lists if spread_lists is None else spread_lists
    first = first.select(F.col("itemset").alias("left"), "bucket", F.col("tids").alias("one"))
    second = lists.select(F.col("itemset").alias("right"), "bucket", F.col("tids").alias("two"))
    if candidate_rows is None:
        met = first.join(parents, "left")
    else:
        met = lookup_join(first, parents, "left", candidate_rows, 120 + 12 * k, ["bucket"])
    return (
        met.join(second, ["right", "bucket"])
        .select("itemset", "bucket", F.array_intersect("one", "two").alias("tids"))
        .filter(F.size("tids") > 0)
    )


def tid_list_sizes(lists: DataFrame, min_support: int = 1) -> DataFrame:
    """Support of each itemset, summed over its buckets: ``(itemset, freq)``."""
    return (
        lists.groupBy("itemset")
        .agg(F.sum(F.size("tids")).alias("freq"))
        .filter(F.col("freq") >= min_support)
    )


def intersect_classes(
    lists: DataFrame, classes: DataFrame | None = None, class_rows: int = 0, row_bytes: int = 256, largest: int = 0
) -> DataFrame:
    """Tid lists one item longer, each from two lists of its equivalence class.

    `lists` are ``(stem, last, bucket, tids)``, the itemset being the stem and the last
    item. All lists of a stem and bucket meet in one place and are intersected there, so a
    list is shuffled once, however many candidates it is in. `classes` (``stem``,
    ``lasts``) restricts them to its members; `class_rows` and `row_bytes` are its size.
    A stem with more than CLASS_LISTS members, up to `largest`, is cut into blocks; each
    pair of blocks meets in a place of its own.
    """
    key = ["stem", "bucket"]
    if classes is not None:
        lists = lookup_join(lists, classes, "stem", class_rows, row_bytes, ["last", "bucket"])
        lists = lists.filter((F.size("lasts") > 1) & F.array_contains("lasts", F.col("last")))
    if largest <= CLASS_LISTS:
        lists = lists.select(*key, "last", "tids")
        left, right = lists, lists
    else:
        cut = F.ceil(F.size("lasts") / CLASS_LISTS).cast("int")
        blocks = lists.withColumn("_own", F.pmod(F.xxhash64("last"), cut)).withColumn(
            "_other", F.explode(F.sequence(F.lit(0), cut - 1))
        )
        left = blocks.select(*key, F.col("_own").alias("i"), F.col("_other").alias("j"), "last", "tids")
        right = blocks.select(*key, F.col("_other").alias("i"), F.col("_own").alias("j"), "last", "tids")
        key = [*key, "i", "j"]
    left = left.withColumnsRenamed({"last": "a", "tids": "one"})
    right = right.withColumnsRenamed({"last": "b", "tids": "two"})
    return (
        left.join(right, key)
        .filter("a < b")
        .select(
            F.concat("stem", F.array("a")).alias("stem"),
            F.col("b").alias("last"),
            "bucket",
            once(F.array_intersect("one", "two")).alias("tids"),
        )
        .filter(F.size("tids") > 0)
    )
