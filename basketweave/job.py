"""The batch job: read transactions, mine them, save itemsets and rules.

    spark-submit basketweave/job.py INPUT OUTPUT ALGORITHM MIN_SUPPORT [options]

INPUT is text with one transaction per line, or a parquet table when --key and
--item name its columns. Results go to OUTPUT/ALGORITHM_itemsets and
OUTPUT/ALGORITHM_rules.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketweave.api import ALGORITHMS, ALIASES, DEFAULT_GROUPS, frequent_itemsets
from basketweave.operators import association_rules, itemset_support, transaction_count
from basketweave.sources import read_transactions, write_itemsets, write_rules
from basketweave.sources.writers import FORMATS
from basketweave.workspace import Workspace


def parse_arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Mine frequent itemsets and association rules.")
    parser.add_argument("input", help="text file or folder, or a parquet table")
    parser.add_argument("output", help="folder for the results")
    parser.add_argument("algorithm", choices=[*ALGORITHMS, *ALIASES])
    parser.add_argument("min_support", type=int, help="number of transactions")
    parser.add_argument("num_groups", type=int, nargs="?", default=DEFAULT_GROUPS)
    parser.add_argument("--delimiter", default=" ", help="between the items of a text line")
    parser.add_argument("--key", help="transaction column of a parquet input")
    parser.add_argument("--item", help="item column of a parquet input")
    parser.add_argument("--max-len", type=int)
    parser.add_argument("--min-confidence", type=float, default=0.0)
    parser.add_argument("--format", choices=FORMATS, default="text")
    parser.add_argument("--overwrite", action="store_true", help="replace earlier results")
    parser.add_argument("--ordered", action="store_true", help="sort the itemsets by count")
    parser.add_argument("--no-save", dest="save", action="store_false")
    arguments = parser.parse_args(argv)
    if (arguments.key is None) != (arguments.item is None):
        parser.error("--key and --item go together")
    return arguments


def read_input(spark: SparkSession, arguments: argparse.Namespace) -> DataFrame:
    if arguments.key is None:
        return read_transactions(spark, arguments.input, arguments.delimiter)
    return spark.read.parquet(arguments.input).select(
        F.col(arguments.key).alias("tid"), F.col(arguments.item).cast("string").alias("item")
    )


def mine_job(spark: SparkSession, arguments: argparse.Namespace) -> DataFrame:
    """Run the job and return the itemsets with their support."""
    data = read_input(spark, arguments)
    ws = Workspace(spark)
    n = ws.write("transaction_count", transaction_count(data)).df
    found = frequent_itemsets(
        data,
        arguments.min_support,
        arguments.algorithm,
        num_groups=arguments.num_groups,
        max_len=arguments.max_len,
        workspace=ws,
    )
    itemsets = itemset_support(found, n)
    if arguments.save:
        mode = "overwrite" if arguments.overwrite else "errorifexists"
        target = f"{arguments.output.rstrip('/')}/{arguments.algorithm}"
        write_itemsets(
            itemsets, f"{target}_itemsets", arguments.format, mode, ordered=arguments.ordered
        )
        rules = association_rules(found, n, arguments.min_confidence, workspace=ws)
        write_rules(rules, f"{target}_rules", arguments.format, mode)
    return itemsets


def main(argv: list[str] | None = None) -> None:
    arguments = parse_arguments(argv)
    spark = SparkSession.builder.appName(f"itemsets-{arguments.algorithm}").getOrCreate()
    mine_job(spark, arguments)


if __name__ == "__main__":
    main()
