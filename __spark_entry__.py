"""

Arrays are emitted as comma-joined strings, counts as BIGINT and ratios rounded
to 6 places, so that both engines give the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import basketweave as bw
from basketweave import job
from basketweave import operators as ops
from basketweave import sources as src
from basketweave.sources.writers import RULE_LABELS

# The driver may delete corpus_pipeline.py and basketweave/llm; all else works without them.
try:
    from basketweave.llm import queries as llm
except ImportError:
    llm = None
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

# Thresholds that the queries and their SQL share.
BRAND, BRAND_HIGH, TYPE, EVENT = 50, 300, 100, 5
BLANK, DENSE = 10, 300
GROUPS = 4
BUCKETS = 8
# Words count as frequent from this share of all documents on.
WORD_SHARE = 0.4


def joined(column: str) -> F.Column:
    return F.array_join(F.col(column).cast("array<string>"), ",").alias(column)


def shown(itemsets: DataFrame) -> DataFrame:
    return itemsets.select(joined("itemset"), F.col("k").cast("bigint").alias("k"), "freq")


def brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.basket_view(spark, sf_dir, "order_brand")


def event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.basket_view(spark, sf_dir, "userday_event")


def word_support(spark: SparkSession, sf_dir: str) -> int:
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    return max(1, -int(-WORD_SHARE * n // 1))


# --- sources ---------------------------------------------------------------


def q_read_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets written as text lines, read back and counted by content."""
    path = f"{bw.Workspace(spark).path}/lines"
    baskets = src.transactions_from_rows(brand(spark, sf_dir), "tid", "item")
    baskets.select(F.array_join("items", " ").alias("value")).write.text(path)
    lines = src.read_transactions(spark, path)
    return lines.groupBy(joined("items")).agg(F.count(F.lit(1)).alias("n"))


def q_assign_tids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense numbers for the distinct baskets: their range and their number."""
    baskets = src.transactions_from_rows(event(spark, sf_dir), "tid", "item").select("items")
    numbered = src.assign_tids(baskets, "tid", dense=True)
    return numbered.agg(
        F.min("tid").alias("first"), F.max("tid").alias("last"), F.count_distinct("tid").alias("n")
    )


def q_assign_tids_rows(dense: bool) -> Query:
    """Numbers joined back to the baskets that they were given to."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ws = bw.Workspace(spark)
        baskets = src.transactions_from_rows(event(spark, sf_dir), "tid", "item")
        numbered = src.assign_tids(baskets.withColumnRenamed("tid", "key"), "tid", dense, ws)
        numbered = ws.write("numbered_baskets", numbered.select("tid", "key", "items")).df
        once = numbered.groupBy("tid").agg(F.count(F.lit(1)).alias("n")).filter("n = 1")
        return numbered.join(once, "tid").select(F.col("key").alias("tid"), joined("items"))

    return run


def q_basket_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.transactions_from_rows(brand(spark, sf_dir), "tid", "item").select(
        "tid", joined("items")
    )


def q_basket_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.explode_items(src.transactions_from_rows(brand(spark, sf_dir), "tid", "item"))


def q_write_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Itemsets with support, saved as JSON and read back."""
    rows = event(spark, sf_dir)
    found = bw.itemset_support(
        bw.frequent_itemsets(rows, EVENT, "subsets"), bw.transaction_count(rows)
    )
    path = f"{bw.Workspace(spark).path}/itemsets"
    bw.write_itemsets(found, path, fmt="json")
    back = spark.read.schema("itemset ARRAY<STRING>, freq BIGINT, support DOUBLE").json(path)
    return back.select(joined("itemset"), "freq", F.round("support", 6).alias("support"))


def q_write_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules saved as parquet and read back."""
    rows = event(spark, sf_dir)
    found = bw.association_rules(
        bw.frequent_itemsets(rows, EVENT, "subsets"), bw.transaction_count(rows)
    )
    path = f"{bw.Workspace(spark).path}/rules"
    bw.write_rules(found, path)
    return shown_rules(spark.read.schema(found.schema).parquet(path))


LINE_SCHEMA = "value STRING"


def q_write_itemsets_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Itemsets with support, saved as text lines and read back."""
    rows = event(spark, sf_dir)
    found = bw.itemset_support(
        bw.frequent_itemsets(rows, EVENT, "prefix_array"), bw.transaction_count(rows)
    )
    path = f"{bw.Workspace(spark).path}/itemsets"
    bw.write_itemsets(found, path, fmt="text")
    return read_itemset_lines(spark, path)


def read_itemset_lines(spark: SparkSession, path: str) -> DataFrame:
    part = r"^\(Set\((.*)\),\((\d+),(.*)\)\)$"
    lines = spark.read.schema(LINE_SCHEMA).text(path)
    return lines.select(
        F.replace(F.regexp_extract("value", part, 1), F.lit(", "), F.lit(",")).alias("itemset"),
        F.regexp_extract("value", part, 2).cast("bigint").alias("freq"),
        F.round(F.regexp_extract("value", part, 3).cast("double"), 6).alias("support"),
    )


def q_write_rules_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules saved as text lines and read back."""
    rows = event(spark, sf_dir)
    found = bw.association_rules(
        bw.frequent_itemsets(rows, EVENT, "prefix_array"), bw.transaction_count(rows)
    )
    path = f"{bw.Workspace(spark).path}/rules"
    bw.write_rules(found, path, fmt="text")
    return read_rule_lines(spark, path)


def read_rule_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of `write_rules`, taken apart at their labels."""
    lines = spark.read.schema(LINE_SCHEMA).text(path)
    values = {n: r"Set\((.*)\)" if n in ("antecedent", "consequent") else "(.*)" for n in RULE_LABELS}
    part = "".join(label + values[n] for n, label in RULE_LABELS.items()) + "$"
    columns = []
    for i, name in enumerate(RULE_LABELS, 1):
        text = F.regexp_extract("value", part, i)
        is_set = name in ("antecedent", "consequent")
        shown = F.replace(text, F.lit(", "), F.lit(",")) if is_set else F.round(text.cast("double"), 6)
        columns.append(shown.alias(name))
    return lines.select(*columns)


def q_mine_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job from a parquet table to its text output, read back."""
    ws = bw.Workspace(spark)
    source = ws.write("source", brand(spark, sf_dir)).path
    arguments = ["--key", "tid", "--item", "item", "--format", "text"]
    options = job.parse_arguments([source, f"{ws.path}/out", "nonordfp", str(BRAND_HIGH), *arguments])
    job.mine_job(spark, options)
    return read_itemset_lines(spark, f"{ws.path}/out/nonordfp_itemsets")


# --- counting --------------------------------------------------------------


def brand_rank(spark: SparkSession, sf_dir: str, min_support: int = BRAND) -> DataFrame:
    return ops.item_rank(ops.frequent_items(brand(spark, sf_dir), min_support))


def brand_pruned(spark: SparkSession, sf_dir: str, min_support: int = BRAND) -> DataFrame:
    return ops.prune_transactions(
        brand(spark, sf_dir), brand_rank(spark, sf_dir, min_support)
    )


def q_itemset_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = brand(spark, sf_dir)
    found = bw.itemset_support(
        bw.frequent_itemsets(rows, BRAND_HIGH), bw.transaction_count(rows)
    )
    return found.select(joined("itemset"), "freq", F.round("support", 6).alias("support"))


# --- level-wise ------------------------------------------------------------


def brand_singles(spark: SparkSession, sf_dir: str, min_support: int) -> DataFrame:
    return ops.frequent_items(brand(spark, sf_dir), min_support).select(
        F.array("item").alias("itemset"), "freq"
    )


def brand_pairs(spark: SparkSession, sf_dir: str, min_support: int) -> DataFrame:
    return ops.pair_counts(brand(spark, sf_dir), min_support).select(
        F.array("item_a", "item_b").alias("itemset"), "freq"
    )


def brand_candidates_k3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = brand_pairs(spark, sf_dir, BRAND_HIGH)
    return ops.prune_candidates(ops.generate_candidates(pairs), pairs)


def brand_occurrences(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """Occurrences of all k-itemsets in the baskets, items by name."""
    merged = (
        src.transactions_from_rows(brand(spark, sf_dir), "tid", "item")
        .groupBy(F.col("items").alias("rest"))
        .agg(F.count(F.lit(1)).alias("w"))
    )
    held = merged.select(F.array().cast("array<string>").alias("itemset"), "rest", "w")
    for _ in range(k):
        held = ops.extend_occurrences(held)
    return held


def q_candidate_counts(k: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if k == 2:
            candidates = ops.generate_candidates(brand_singles(spark, sf_dir, BRAND))
        else:
            candidates = brand_candidates_k3(spark, sf_dir)
        counts = ops.count_candidates(brand_occurrences(spark, sf_dir, k - 1), candidates)
        return counts.select(joined("itemset"), "freq")

    return run


def q_candidate_counts_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidate triples counted by walking their tree."""
    ws = bw.Workspace(spark)
    ranked = ws.write("rank", brand_rank(spark, sf_dir, BRAND_HIGH)).df
    names = F.array_sort(F.collect_list(F.struct("rk", "item")))
    lookup = ranked.agg(F.transform(names, lambda e: e["item"])).scalar()
    merged = ops.compress_transactions(brand_pruned(spark, sf_dir, BRAND_HIGH))
    ranks = F.transform("itemset", lambda x: F.array_position(F.col("names"), x).cast("int") - 1)
    coded = brand_candidates_k3(spark, sf_dir).withColumn("names", lookup)
    candidates = ws.write("candidates", coded.select(F.sort_array(ranks).alias("itemset")))
    counts = ops.count_candidates_tree(merged, candidates.df, candidates.rows, 3, 3)
    named = F.transform("itemset", lambda r: F.get(F.col("names"), r))
    return counts.withColumn("names", lookup).select(
        F.array_join(F.sort_array(named), ",").alias("itemset"), "freq"
    )


# --- vertical --------------------------------------------------------------


def q_tid_list_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = ops.tid_lists(brand(spark, sf_dir), BRAND, BUCKETS)
    return ops.tid_list_sizes(lists).select(joined("itemset"), "freq")


def q_tid_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = ops.tid_lists(event(spark, sf_dir), EVENT, BUCKETS)
    return lists.select(
        F.element_at("itemset", 1).alias("item"), F.explode("tids").alias("tid")
    )


def q_tid_intersections(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = ops.tid_lists(brand(spark, sf_dir), BRAND, BUCKETS)
    met = ops.intersect_tid_lists(lists, brand_pairs(spark, sf_dir, BRAND))
    return ops.tid_list_sizes(met, BRAND).select(joined("itemset"), "freq")


def q_tid_intersections_k3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of frequent pairs met into those of triples."""
    ws = bw.Workspace(spark)
    # Written, as each is read several times.
    found = ws.write("pairs", brand_pairs(spark, sf_dir, BRAND_HIGH))
    triples = ops.prune_candidates(ops.generate_candidates(found.df, found.rows), found.df, found.rows, 2)
    candidates = ws.write("candidates", triples)
    lists = ws.write("lists", ops.tid_lists(brand(spark, sf_dir), BRAND_HIGH, BUCKETS, ws))
    pairs = ws.write("pair_lists", ops.intersect_tid_lists(lists.df, found.df, found.rows, 2, lists.spread(8)))
    met = ops.intersect_tid_lists(pairs.df, candidates.df, candidates.rows, 3, pairs.spread(8))
    return ops.tid_list_sizes(met).select(joined("itemset"), "freq")


def q_class_intersections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists met within their equivalence classes, from single items to triples."""
    lists = ops.tid_lists(brand(spark, sf_dir), BRAND_HIGH, BUCKETS).select(
        F.array().cast("array<string>").alias("stem"),
        F.element_at("itemset", 1).alias("last"),
        "bucket",
        "tids",
    )
    triples = ops.intersect_classes(ops.intersect_classes(lists))
    sizes = ops.tid_list_sizes(
        triples.withColumn("itemset", F.concat("stem", F.array("last"))), BRAND_HIGH
    )
    return sizes.select(joined("itemset"), "freq")


def q_tid_bitmap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs counted by intersecting the bitmaps of their items."""
    ws = bw.Workspace(spark)
    bitmaps = ws.write("bitmaps", ops.tid_bitmaps(brand(spark, sf_dir), BRAND, ws)).df
    pairs = ops.intersect_bitmap_classes(
        bitmaps.select(F.array().cast("array<string>").alias("stem"), F.col("item").alias("last"), "block", "bits")
    )
    sizes = ops.bitmap_sizes(
        pairs.withColumn("itemset", F.concat("stem", F.array("last"))), "itemset", BRAND
    )
    return sizes.select(joined("itemset"), "freq")


# --- pattern growth --------------------------------------------------------


def brand_base(spark: SparkSession, sf_dir: str, min_support: int) -> DataFrame:
    merged = ops.compress_transactions(brand_pruned(spark, sf_dir, min_support))
    return ops.conditional_pattern_base(ops.pattern_base(merged), keep_empty=True)


def q_conditional_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ops.conditional_transactions(brand_pruned(spark, sf_dir), GROUPS)
    return found.select("tid", F.col("grp").cast("bigint").alias("grp"), joined("prefix"))


def q_conditional_item_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ops.conditional_item_counts(brand_base(spark, sf_dir, BRAND_HIGH), BRAND_HIGH)
    return counts.select(joined("suffix"), F.col("item").cast("bigint").alias("item"), "freq")


def q_project_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = brand_base(spark, sf_dir, BRAND_HIGH)
    keep = ops.kept_items(ops.conditional_item_counts(base, BRAND_HIGH))
    projected = ops.project_prefixes(base, keep)
    return projected.groupBy(joined("suffix"), joined("prefix")).agg(F.sum("w").alias("w"))


def q_pair_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of frequent words, summed in blocks of the triangular matrix."""
    ws, words = bw.Workspace(spark), src.basket_view(spark, sf_dir, "document_words")
    support = word_support(spark, sf_dir)
    ranked = ws.write("rank", ops.item_rank(ops.frequent_items(words, support), ws)).df
    merged = ops.compress_transactions(ops.prune_transactions(words, ranked))
    baskets = ws.write("baskets", merged, width=F.max(F.size("prefix")))
    pairs = ops.matrix_pairs(ops.pair_matrix(baskets.df, baskets.stats["width"]), support)
    left, right = (ranked.select(F.col("rk").alias(s), F.col("item").alias(n)) for s, n in (("left", "x"), ("right", "y")))
    return pairs.join(left, "left").join(right, "right").select(
        F.least("x", "y").alias("item_a"), F.greatest("x", "y").alias("item_b"), "freq"
    )


def q_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of all baskets, every node with its path and the number of its children."""
    ws = bw.Workspace(spark)
    merged = ops.compress_transactions(brand_pruned(spark, sf_dir))
    tree = ws.write("tree", ops.prefix_tree(merged)).df
    children = tree.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("children"))
    return (
        tree.join(ops.tree_paths(tree, ws).select("node", "path"), "node")
        .join(children, "node", "left")
        .select(
            joined("path"),
            *[F.col(c).cast("bigint").alias(c) for c in ("item", "depth")],
            "w",
            F.coalesce("children", F.lit(0)).alias("children"),
        )
    )


def q_project_prefixes_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern bases without infrequent items, each in the order of its own counts."""
    base = brand_base(spark, sf_dir, BRAND_HIGH)
    keep = ops.kept_items(ops.conditional_item_counts(base, BRAND_HIGH))
    projected = ops.project_prefixes(base, keep, local_order=True)
    return projected.groupBy(joined("suffix"), joined("prefix")).agg(F.sum("w").alias("w"))


# --- strategies and rules --------------------------------------------------


def mined(view: str, min_support: int, algorithm: str, **options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = src.basket_view(spark, sf_dir, view)
        return shown(bw.frequent_itemsets(rows, min_support, algorithm, **options))

    return run


def mined_words(algorithm: str, max_len: int | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = src.basket_view(spark, sf_dir, "document_words")
        ms = word_support(spark, sf_dir)
        return shown(bw.frequent_itemsets(rows, ms, algorithm, max_len=max_len))

    return run


def shown_rules(rules: DataFrame) -> DataFrame:
    ratios = ["antecedent_support", "consequent_support", "support", "confidence", "lift"]
    return rules.select(
        joined("antecedent"),
        "consequent",
        *[F.round(r, 6).alias(r) for r in ratios if r in rules.columns],
    )


def ruled(view: str, min_support: int, algorithm: str = "pair_pruned", **options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = src.basket_view(spark, sf_dir, view)
        found = bw.frequent_itemsets(rows, min_support, algorithm)
        return shown_rules(bw.association_rules(found, bw.transaction_count(rows), **options))

    return run


def ruled_builtin(view: str, min_support: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rules = bw.association_rules_builtin(src.basket_view(spark, sf_dir, view), min_support)
        return shown_rules(rules.withColumn("consequent", F.element_at("consequent", 1)))

    return run


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """Association rules between the part brands of an order, at sf0.001."""
    return ruled("order_brand", 5)(spark, sf_dir)


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "read_transactions": q_read_transactions,
        "assign_tids": q_assign_tids,
        "assign_tids_rows": q_assign_tids_rows(False),
        "assign_tids_dense_rows": q_assign_tids_rows(True),
        "basket_items": q_basket_items,
        "basket_long": q_basket_long,
        "write_itemsets": q_write_itemsets,
        "write_rules": q_write_rules,
        "write_itemsets_text": q_write_itemsets_text,
        "write_rules_text": q_write_rules_text,
        "mine_job": q_mine_job,
        "transaction_count": lambda s, d: bw.transaction_count(brand(s, d)),
        "item_counts": lambda s, d: ops.item_counts(brand(s, d)),
        "item_counts_words": lambda s, d: ops.item_counts(
            src.basket_view(s, d, "document_words")
        ),
        "frequent_items": lambda s, d: ops.frequent_items(event(s, d), EVENT),
        "item_rank": lambda s, d: brand_rank(s, d).select(
            "item", "freq", F.col("rk").cast("bigint").alias("rk")
        ),
        "item_rank_sorted": lambda s, d: ops.item_rank(
            ops.item_counts(src.basket_view(s, d, "document_words"))
        ).select("item", "freq", F.col("rk").cast("bigint").alias("rk")),
        "pruned_transactions": lambda s, d: brand_pruned(s, d).select("tid", joined("items")),
        "compressed_transactions": lambda s, d: ops.compress_transactions(
            brand_pruned(s, d)
        ).select(joined("prefix"), "w"),
        "itemset_support": q_itemset_support,
        "apriori_candidates_k2": lambda s, d: ops.generate_candidates(
            brand_singles(s, d, BRAND)
        ).select(joined("itemset")),
        "apriori_pruned_candidates_k3": lambda s, d: brand_candidates_k3(s, d).select(
            joined("itemset")
        ),
        "candidate_counts_k2": q_candidate_counts(2),
        "candidate_counts_k3": q_candidate_counts(3),
        "candidate_counts_tree": q_candidate_counts_tree,
        "tid_lists": q_tid_lists,
        "tid_list_sizes": q_tid_list_sizes,
        "tid_intersections_k2": q_tid_intersections,
        "tid_intersections_k3": q_tid_intersections_k3,
        "tid_bitmaps": lambda s, d: ops.bitmap_sizes(
            ops.tid_bitmaps(brand(s, d), BRAND), "item"
        ).select(F.col("item").alias("itemset"), "freq"),
        "tid_bitmap_pairs": q_tid_bitmap_pairs,
        "class_intersections_k3": q_class_intersections,
        "conditional_transactions": q_conditional_transactions,
        "conditional_pattern_base": lambda s, d: brand_base(s, d, BRAND).select(
            joined("suffix"), joined("prefix"), "w"
        ),
        "conditional_pattern_base_k2": lambda s, d: ops.conditional_pattern_base(
            brand_base(s, d, BRAND_HIGH)
        ).select(joined("suffix"), joined("prefix"), "w"),
        "conditional_item_counts": q_conditional_item_counts,
        "prefix_tree": q_prefix_tree,
        "pair_matrix": q_pair_matrix,
        "projected_prefixes": q_project_prefixes,
        "projected_prefixes_local": q_project_prefixes_local,
        "pair_counts": lambda s, d: ops.pair_counts(brand(s, d)),
        "pair_counts_words": lambda s, d: ops.pair_counts(
            src.basket_view(s, d, "document_words"), word_support(s, d)
        ),
        "association_rules": ruled("order_brand", BRAND),
        "association_rules_lift": ruled("userday_event", EVENT, lift=True),
        "association_rules_confident": ruled("order_type", TYPE, min_confidence=0.5),
        "association_rules_builtin": ruled_builtin("userday_event", EVENT),
        "association_rules_blank": ruled("order_small_brand", BLANK, lift=True),
        "association_rules_builtin_blank": ruled_builtin("order_small_brand", BLANK),
        "frequent_itemsets_pairs_only": mined("order_type", TYPE, "fpgrowth", max_len=2),
        "frequent_itemsets_one_group": mined("order_brand", BRAND_HIGH, "fpgrowth", num_groups=1),
    }
    for algorithm in bw.ALGORITHMS:
        found[f"frequent_itemsets_{algorithm}"] = mined("order_brand", BRAND, algorithm)
        found[f"frequent_itemsets_{algorithm}_deep"] = mined("order_type", TYPE, algorithm)
        found[f"frequent_itemsets_{algorithm}_words"] = mined_words(algorithm)
        found[f"frequent_itemsets_{algorithm}_dense"] = mined(
            "customer_brand", DENSE, algorithm, max_len=3
        )
    if llm:
        found |= llm.QUERIES
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


# --- SQL -------------------------------------------------------------------

VIEWS = {
    "order_brand": (
        "SELECT DISTINCT l_orderkey AS tid, p_brand AS item"
        " FROM lineitem JOIN part ON l_partkey = p_partkey"
    ),
    "order_type": (
        "SELECT DISTINCT l_orderkey AS tid, p_type AS item"
        " FROM lineitem JOIN part ON l_partkey = p_partkey"
    ),
    "userday_event": (
        "SELECT DISTINCT CAST(user_id AS VARCHAR) || '|' || strftime(ts, '%Y-%m-%d') AS tid,"
        " event_type AS item FROM events"
    ),
    "order_small_brand": (
        "SELECT DISTINCT l_orderkey AS tid, CASE WHEN p_size <= 10 THEN p_brand ELSE '' END AS item"
        " FROM lineitem JOIN part ON l_partkey = p_partkey"
    ),
    "customer_brand": (
        "SELECT DISTINCT o_custkey AS tid, p_brand AS item FROM lineitem"
        " JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey"
    ),
    "document_words": (
        "SELECT DISTINCT tid, item FROM (SELECT doc_id AS tid,"
        " unnest(string_split(text, ' ')) AS item FROM documents) WHERE item <> ''"
    ),
}
WORD_SUPPORT = f"(SELECT ceil({WORD_SHARE} * count(*)) FROM documents)"


def with_baskets(view: str, *more: str, recursive: bool = False) -> str:
    parts = [f"b AS ({VIEWS[view]})", *more]
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


def ranks(min_support) -> tuple[str, str]:
    """Item ranks `r` and baskets of ranks `p`."""
    return (
        "r AS (SELECT item, count(*) AS freq,"
        " row_number() OVER (ORDER BY count(*) DESC, item) - 1 AS rk"
        f" FROM b GROUP BY item HAVING count(*) >= {min_support})",
        "p AS (SELECT tid, rk FROM b JOIN r USING (item))",
    )


def itemsets(view: str, min_support, max_len: int | None = None) -> tuple[str, ...]:
    """All subsets of all baskets of frequent items, counted: `f`."""
    stop = "" if max_len is None else f" AND s.k < {max_len}"
    return (
        "d AS (SELECT tid, item FROM b WHERE item IN (SELECT item FROM b"
        f" WHERE item <> '' GROUP BY item HAVING count(*) >= {min_support}))",
        "s AS (SELECT tid, item AS last, item AS itemset, 1 AS k FROM d"
        " UNION ALL SELECT s.tid, d.item, s.itemset || ',' || d.item, s.k + 1"
        f" FROM s JOIN d ON d.tid = s.tid AND d.item > s.last{stop})",
        "f AS (SELECT itemset, CAST(k AS BIGINT) AS k, count(*) AS freq FROM s"
        f" GROUP BY itemset, k HAVING count(*) >= {min_support})",
    )


def itemsets_sql(view: str, min_support, max_len: int | None = None) -> str:
    return (
        with_baskets(view, *itemsets(view, min_support, max_len), recursive=True)
        + "SELECT itemset, k, freq FROM f"
    )


def support_sql(view: str, min_support: int) -> str:
    return (
        with_baskets(view, *itemsets(view, min_support), recursive=True)
        + "SELECT itemset, freq, round(freq / (SELECT count(DISTINCT tid) FROM b), 6) AS support"
        " FROM f"
    )


def rules_sql(view: str, min_support: int, columns: str, min_confidence: float = 0.0) -> str:
    """`columns` selects among the named ratios of each rule."""
    rules = (
        "x AS (SELECT itemset, freq, unnest(string_split(itemset, ',')) AS consequent"
        " FROM f WHERE k > 1)",
        "y AS (SELECT *, array_to_string(list_filter(string_split(itemset, ','),"
        " lambda i: i <> consequent), ',') AS antecedent FROM x)",
        "n AS (SELECT count(DISTINCT tid) AS n FROM b)",
        "q AS (SELECT antecedent, consequent, y.freq / a.freq AS conf,"
        " round(a.freq / n, 6) AS antecedent_support, round(c.freq / n, 6) AS consequent_support,"
        " round(y.freq / n, 6) AS support, round(y.freq / a.freq, 6) AS confidence,"
        " round(y.freq / a.freq * n / c.freq, 6) AS lift"
        " FROM y JOIN f AS a ON a.itemset = antecedent JOIN f AS c ON c.itemset = consequent, n)",
    )
    return (
        with_baskets(view, *itemsets(view, min_support), *rules, recursive=True)
        + f"SELECT antecedent, consequent, {columns} FROM q WHERE conf >= {min_confidence}"
    )


RULE_COLUMNS = "antecedent_support, consequent_support, support, confidence"

PAIRS = (
    "SELECT x.item AS item_a, y.item AS item_b, count(*) AS freq"
    " FROM b AS x JOIN b AS y ON x.tid = y.tid AND x.item < y.item GROUP BY 1, 2"
)


def oracle_sql() -> dict[str, str]:
    base = with_baskets("order_brand")
    ranked = with_baskets("order_brand", *ranks(BRAND))
    ranked_high = with_baskets("order_brand", *ranks(BRAND_HIGH))
    pairs_high = f"l AS (SELECT * FROM ({PAIRS}) WHERE freq >= {BRAND_HIGH})"
    triples = (
        "c AS (SELECT x.item_a AS a, x.item_b AS b, y.item_b AS c FROM l AS x"
        " JOIN l AS y ON x.item_a = y.item_a AND x.item_b < y.item_b"
        " JOIN l AS z ON z.item_a = x.item_b AND z.item_b = y.item_b)"
    )
    baskets = "SELECT tid, string_agg(item, ',' ORDER BY item) AS items FROM b GROUP BY tid"
    rank_arrays = "SELECT tid, string_agg(rk, ',' ORDER BY rk) AS {} FROM p GROUP BY tid"
    sql = {
        "read_transactions": base
        + f"SELECT items, count(*) AS n FROM ({baskets}) GROUP BY items",
        "assign_tids": with_baskets("userday_event")
        + "SELECT 0::BIGINT AS first, count(DISTINCT tid) - 1 AS last,"
        " count(DISTINCT tid) AS n FROM b",
        "basket_items": base + baskets,
        "basket_long": base + "SELECT tid, item FROM b",
        "assign_tids_rows": with_baskets("userday_event") + baskets,
        "assign_tids_dense_rows": with_baskets("userday_event") + baskets,
        "write_itemsets_text": support_sql("userday_event", EVENT),
        "write_rules_text": rules_sql("userday_event", EVENT, RULE_COLUMNS),
        "mine_job": support_sql("order_brand", BRAND_HIGH),
        "write_itemsets": support_sql("userday_event", EVENT),
        "write_rules": rules_sql("userday_event", EVENT, RULE_COLUMNS),
        "transaction_count": base + "SELECT count(DISTINCT tid) AS n FROM b",
        "item_counts": base + "SELECT item, count(*) AS freq FROM b GROUP BY item",
        "item_counts_words": with_baskets("document_words")
        + "SELECT item, count(*) AS freq FROM b GROUP BY item",
        "frequent_items": with_baskets("userday_event")
        + f"SELECT item, count(*) AS freq FROM b GROUP BY item HAVING count(*) >= {EVENT}",
        "item_rank": ranked + "SELECT item, freq, rk FROM r",
        "item_rank_sorted": with_baskets("document_words", *ranks(1))
        + "SELECT item, freq, rk FROM r",
        "pruned_transactions": ranked + rank_arrays.format("items"),
        "compressed_transactions": ranked
        + f"SELECT prefix, count(*) AS w FROM ({rank_arrays.format('prefix')}) GROUP BY prefix",
        "itemset_support": support_sql("order_brand", BRAND_HIGH),
        "apriori_candidates_k2": ranked
        + "SELECT x.item || ',' || y.item AS itemset FROM r AS x JOIN r AS y ON x.item < y.item",
        "apriori_pruned_candidates_k3": with_baskets("order_brand", pairs_high, triples)
        + "SELECT a || ',' || b || ',' || c AS itemset FROM c",
        "candidate_counts_k2": with_baskets(
            "order_brand",
            f"h AS (SELECT item FROM b GROUP BY item HAVING count(*) >= {BRAND})",
        )
        + f"SELECT item_a || ',' || item_b AS itemset, freq FROM ({PAIRS})"
        " WHERE item_a IN (SELECT item FROM h) AND item_b IN (SELECT item FROM h)",
        "candidate_counts_k3": with_baskets("order_brand", pairs_high, triples)
        + "SELECT a || ',' || c.b || ',' || c AS itemset, count(*) AS freq FROM c"
        " JOIN b AS x ON x.item = a JOIN b AS y ON y.tid = x.tid AND y.item = c.b"
        " JOIN b AS z ON z.tid = x.tid AND z.item = c GROUP BY 1",
        "candidate_counts_tree": with_baskets("order_brand", pairs_high, triples)
        + "SELECT a || ',' || c.b || ',' || c AS itemset, count(*) AS freq FROM c"
        " JOIN b AS x ON x.item = a JOIN b AS y ON y.tid = x.tid AND y.item = c.b"
        " JOIN b AS z ON z.tid = x.tid AND z.item = c GROUP BY 1",
        "tid_lists": with_baskets("userday_event")
        + "SELECT item, tid FROM b WHERE item IN"
        f" (SELECT item FROM b GROUP BY item HAVING count(*) >= {EVENT})",
        "tid_list_sizes": base
        + "SELECT item AS itemset, count(*) AS freq FROM b GROUP BY item"
        f" HAVING count(*) >= {BRAND}",
        "tid_bitmaps": base
        + "SELECT item AS itemset, count(*) AS freq FROM b GROUP BY item"
        f" HAVING count(*) >= {BRAND}",
        "tid_bitmap_pairs": base
        + "SELECT x.item || ',' || y.item AS itemset, count(*) AS freq"
        " FROM b AS x JOIN b AS y ON x.tid = y.tid AND x.item < y.item"
        f" GROUP BY 1 HAVING count(*) >= {BRAND}",
        "class_intersections_k3": base
        + "SELECT x.item || ',' || y.item || ',' || z.item AS itemset, count(*) AS freq"
        " FROM b AS x JOIN b AS y ON x.tid = y.tid AND x.item < y.item"
        " JOIN b AS z ON z.tid = y.tid AND y.item < z.item"
        f" GROUP BY 1 HAVING count(*) >= {BRAND_HIGH}",
        "tid_intersections_k2": base
        + "SELECT x.item || ',' || y.item AS itemset, count(*) AS freq"
        " FROM b AS x JOIN b AS y ON x.tid = y.tid AND x.item < y.item"
        f" GROUP BY 1 HAVING count(*) >= {BRAND}",
        "conditional_transactions": with_baskets(
            "order_brand",
            *ranks(BRAND),
            f"g AS (SELECT tid, rk % {GROUPS} AS grp, max(rk) AS last FROM p GROUP BY 1, 2)",
        )
        + "SELECT tid, grp, string_agg(rk, ',' ORDER BY rk) AS prefix"
        " FROM g JOIN p USING (tid) WHERE rk <= last GROUP BY tid, grp",
        "conditional_pattern_base": with_baskets(
            "order_brand",
            *ranks(BRAND),
            "g AS (SELECT x.tid, x.rk, coalesce(string_agg(y.rk, ',' ORDER BY y.rk), '') AS prefix"
            " FROM p AS x LEFT JOIN p AS y ON x.tid = y.tid AND y.rk < x.rk GROUP BY 1, 2)",
        )
        + "SELECT CAST(rk AS VARCHAR) AS suffix, prefix, count(*) AS w FROM g GROUP BY 1, 2",
        "tid_intersections_k3": with_baskets("order_brand", pairs_high, triples)
        + "SELECT a || ',' || c.b || ',' || c AS itemset, count(*) AS freq FROM c"
        " JOIN b AS x ON x.item = a JOIN b AS y ON y.tid = x.tid AND y.item = c.b"
        " JOIN b AS z ON z.tid = x.tid AND z.item = c GROUP BY 1",
        "conditional_pattern_base_k2": with_baskets(
            "order_brand",
            *ranks(BRAND_HIGH),
            "g AS (SELECT x.tid, y.rk AS a, x.rk AS b, string_agg(z.rk, ',' ORDER BY z.rk) AS prefix"
            " FROM p AS x JOIN p AS y ON x.tid = y.tid AND y.rk < x.rk"
            " JOIN p AS z ON x.tid = z.tid AND z.rk < y.rk GROUP BY 1, 2, 3)",
        )
        + "SELECT a || ',' || b AS suffix, prefix, count(*) AS w FROM g GROUP BY 1, 2",
        "conditional_item_counts": ranked_high
        + "SELECT CAST(x.rk AS VARCHAR) AS suffix, y.rk AS item, count(*) AS freq"
        " FROM p AS x JOIN p AS y ON x.tid = y.tid AND y.rk < x.rk"
        f" GROUP BY 1, 2 HAVING count(*) >= {BRAND_HIGH}",
        "projected_prefixes": with_baskets(
            "order_brand",
            *ranks(BRAND_HIGH),
            "g AS (SELECT x.tid, x.rk AS suffix, y.rk FROM p AS x"
            " JOIN p AS y ON x.tid = y.tid AND y.rk < x.rk)",
            "h AS (SELECT suffix, rk FROM g GROUP BY 1, 2"
            f" HAVING count(*) >= {BRAND_HIGH})",
            "i AS (SELECT tid, suffix, string_agg(rk, ',' ORDER BY rk) AS prefix"
            " FROM g JOIN h USING (suffix, rk) GROUP BY 1, 2)",
        )
        + "SELECT CAST(suffix AS VARCHAR) AS suffix, prefix, count(*) AS w FROM i GROUP BY 1, 2",
        "projected_prefixes_local": with_baskets(
            "order_brand",
            *ranks(BRAND_HIGH),
            "g AS (SELECT x.tid, x.rk AS suffix, y.rk FROM p AS x"
            " JOIN p AS y ON x.tid = y.tid AND y.rk < x.rk)",
            "h AS (SELECT suffix, rk, count(*) AS n FROM g GROUP BY 1, 2"
            f" HAVING count(*) >= {BRAND_HIGH})",
            "i AS (SELECT tid, suffix, string_agg(rk, ',' ORDER BY n DESC, rk) AS prefix"
            " FROM g JOIN h USING (suffix, rk) GROUP BY 1, 2)",
        )
        + "SELECT CAST(suffix AS VARCHAR) AS suffix, prefix, count(*) AS w FROM i GROUP BY 1, 2",
        "prefix_tree": with_baskets(
            "order_brand",
            *ranks(BRAND),
            "a AS (SELECT list(rk ORDER BY rk) AS l FROM p GROUP BY tid)",
            "n AS (SELECT l[1:i] AS path, count(*) AS w"
            " FROM (SELECT l, unnest(range(1, len(l) + 1)) AS i FROM a) GROUP BY 1)",
            "c AS (SELECT path[1:len(path) - 1] AS path, count(*) AS children FROM n GROUP BY 1)",
        )
        + "SELECT array_to_string(path, ',') AS path, path[len(path)] AS item,"
        " CAST(len(path) AS BIGINT) AS depth, w, coalesce(children, 0) AS children"
        " FROM n LEFT JOIN c USING (path)",
        "pair_counts": base + PAIRS,
        "pair_counts_words": with_baskets(
            "document_words",
            "d AS (SELECT * FROM b WHERE item IN"
            f" (SELECT item FROM b GROUP BY item HAVING count(*) >= {WORD_SUPPORT}))",
        )
        + PAIRS.replace("FROM b AS x JOIN b AS y", "FROM d AS x JOIN d AS y")
        + f" HAVING count(*) >= {WORD_SUPPORT}",
        "pair_matrix": with_baskets(
            "document_words",
            "d AS (SELECT * FROM b WHERE item IN"
            f" (SELECT item FROM b GROUP BY item HAVING count(*) >= {WORD_SUPPORT}))",
        )
        + PAIRS.replace("FROM b AS x JOIN b AS y", "FROM d AS x JOIN d AS y")
        + f" HAVING count(*) >= {WORD_SUPPORT}",
        "association_rules": rules_sql("order_brand", BRAND, RULE_COLUMNS),
        "association_rules_lift": rules_sql("userday_event", EVENT, RULE_COLUMNS + ", lift"),
        "association_rules_confident": rules_sql("order_type", TYPE, RULE_COLUMNS, 0.5),
        "association_rules_builtin": rules_sql(
            "userday_event", EVENT, "support, confidence, lift"
        ),
        "association_rules_blank": rules_sql("order_small_brand", BLANK, RULE_COLUMNS + ", lift"),
        "association_rules_builtin_blank": rules_sql(
            "order_small_brand", BLANK, "support, confidence, lift"
        ),
        "frequent_itemsets_pairs_only": itemsets_sql("order_type", TYPE, max_len=2),
        "frequent_itemsets_one_group": itemsets_sql("order_brand", BRAND_HIGH),
    }
    for algorithm in bw.ALGORITHMS:
        sql[f"frequent_itemsets_{algorithm}"] = itemsets_sql("order_brand", BRAND)
        sql[f"frequent_itemsets_{algorithm}_deep"] = itemsets_sql("order_type", TYPE)
        sql[f"frequent_itemsets_{algorithm}_words"] = itemsets_sql("document_words", WORD_SUPPORT)
        sql[f"frequent_itemsets_{algorithm}_dense"] = itemsets_sql(
            "customer_brand", DENSE, max_len=3
        )
    if llm:
        sql |= llm.SQL
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
