"""Sinks for itemsets and rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FORMATS = ("parquet", "json", "orc", "csv", "text")


def _set_text(items: Column) -> Column:
    return F.concat(F.lit("Set("), F.array_join(items, ", "), F.lit(")"))


def _ratio_text(ratio: Column, short: bool) -> Column:
    return ratio.cast("float" if short else "double").cast("string")


def _save(df: DataFrame, path: str, fmt: str, mode: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}, expected one of {FORMATS}")
    df.write.mode(mode).format(fmt).save(path)


def write_itemsets(
    itemsets: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    ordered: bool = True,
    short_ratios: bool = False,
) -> None:
    """Save ``(itemset, freq, support)``, by default sorted by count ascending.

    `text` gives lines such as ``(Set(a, c),(3,0.6))``, with `short_ratios` as 32-bit
    floats print; `csv` joins each itemset with commas.
    """
    out = itemsets.select("itemset", "freq", "support")
    if ordered:
        out = out.orderBy("freq", "itemset")
    if fmt == "text":
        out = out.select(
            F.concat(
                F.lit("("),
                _set_text(F.col("itemset")),
                F.lit(",("),
                F.col("freq").cast("string"),
                F.lit(","),
                _ratio_text(F.col("support"), short_ratios),
                F.lit("))"),
            ).alias("value")
        )
    elif fmt == "csv":
        out = out.withColumn("itemset", F.array_join("itemset", ","))
    _save(out, path, fmt, mode)


# Fixed labels of a rule line, in the order they are printed.
RULE_LABELS = {
    "antecedent": "Antecedente: ",
    "consequent": " Successivo: ",
    "antecedent_support": " Supporto antecedente: ",
    "consequent_support": " Supporto successivo: ",
    "support": " Supporto: ",
    "confidence": " Confidence: ",
}


def write_rules(
    rules: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    short_ratios: bool = False,
) -> None:
    """Save association rules; `text` gives one labelled line per rule.

    With `short_ratios` its ratios are as 32-bit floats print.
    """
    out = rules
    if fmt == "text":
        shown = {
            "antecedent": _set_text(F.col("antecedent")),
            "consequent": _set_text(F.array("consequent")),
        }
        parts = []
        for name, label in RULE_LABELS.items():
            parts += [F.lit(label), shown.get(name, _ratio_text(F.col(name), short_ratios))]
        out = rules.select(F.concat(*parts).alias("value"))
    elif fmt == "csv":
        out = rules.withColumn("antecedent", F.array_join("antecedent", ","))
    _save(out, path, fmt, mode)
