import json

import pytest

import basketweave as bw
from basketweave import job
from basketweave.sources import assign_tids, explode_items, long_rows
from tests.conftest import baskets_frame, collected, rows_frame
from tests.data import DEMO, DEMO_ITEMSETS


def read_items(spark, path, text, **options):
    path.write_text(text)
    return [r["items"] for r in bw.read_transactions(spark, str(path), **options).collect()]


def test_tokens(spark, tmp_path):
    text = "a a b\na  b \n\n a\n"
    items = read_items(spark, tmp_path / "in.txt", text)
    assert sorted(items) == [[], ["a"], ["a", "b"], ["a", "b"]]


@pytest.mark.parametrize("delimiter", [",", "|", "||", "."])
def test_delimiter_is_literal(spark, tmp_path, delimiter):
    text = delimiter.join(["x y", "b", "a"]) + "\n"
    assert read_items(spark, tmp_path / "in.txt", text, delimiter=delimiter) == [["a", "b", "x y"]]


def test_blank_lines_count(spark, tmp_path):
    (tmp_path / "in.txt").write_text("a b\n\na\n")
    data = bw.read_transactions(spark, str(tmp_path / "in.txt"))
    assert bw.transaction_count(data).collect()[0]["n"] == 3
    found = bw.itemset_support(bw.frequent_itemsets(data, 1, "subsets"), bw.transaction_count(data))
    supports = {tuple(r["itemset"]): round(r["support"], 6) for r in found.collect()}
    assert supports == {("a",): 0.666667, ("b",): 0.333333, ("a", "b"): 0.333333}


def test_empty_file(spark, tmp_path):
    (tmp_path / "in.txt").write_text("")
    data = bw.read_transactions(spark, str(tmp_path / "in.txt"))
    n = bw.transaction_count(data)
    found = bw.frequent_itemsets(data, 1)
    assert n.collect()[0]["n"] == 0
    assert bw.itemset_support(found, n).collect() == []
    assert bw.association_rules(found, n).collect() == []


def test_tids(spark):
    data = spark.createDataFrame([(["a"],), (["b"],), ([],)], "items ARRAY<STRING>").repartition(3)
    assert len({r["tid"] for r in assign_tids(data).collect()}) == 3
    dense = assign_tids(data, dense=True)
    assert sorted(r["tid"] for r in dense.collect()) == [0, 1, 2]
    assert dense.dtypes == [("tid", "bigint"), ("items", "array<string>")]


def test_rows_and_arrays_are_the_same_data(spark):
    baskets = [["b", "a", "a"], ["c"], ["a", ""]]
    rows = rows_frame(spark, baskets)
    arrays = bw.transactions_from_rows(rows, "tid", "item")
    assert {r["tid"]: r["items"] for r in arrays.collect()} == {0: ["a", "b"], 1: ["c"], 2: ["a"]}
    expected = {(0, "a"), (0, "b"), (1, "c"), (2, "a")}
    for long in (explode_items(arrays), long_rows(rows), long_rows(baskets_frame(spark, baskets))):
        pairs = [tuple(r) for r in long.collect()]
        assert set(pairs) == expected and len(pairs) == len(expected)


def demo(spark):
    data = baskets_frame(spark, [line.split() for line in DEMO])
    n = bw.transaction_count(data)
    found = bw.frequent_itemsets(data, 2, "subsets")
    return bw.itemset_support(found, n), bw.association_rules(found, n)


def lines(folder):
    parts = sorted(p for p in folder.iterdir() if p.name.startswith("part-"))
    return [line for p in parts for line in p.read_text().splitlines()]


def test_text_sinks(spark, tmp_path):
    itemsets, rules = demo(spark)
    bw.write_itemsets(itemsets, str(tmp_path / "i"), "text")
    found = lines(tmp_path / "i")
    assert len(found) == 10
    assert "(Set(a, c),(3,0.6))" in found
    counts = [int(line.split(",")[-2].strip("(")) for line in found]
    assert counts == sorted(counts)
    bw.write_rules(rules, str(tmp_path / "r"), "text")
    found = lines(tmp_path / "r")
    assert len(found) == 11
    assert (
        "Antecedente: Set(f) Successivo: Set(a) Supporto antecedente: 0.8"
        " Supporto successivo: 0.6 Supporto: 0.6 Confidence: 0.75"
    ) in found


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc", "csv"])
def test_other_formats(spark, tmp_path, fmt):
    itemsets, rules = demo(spark)
    bw.write_itemsets(itemsets, str(tmp_path / "i"), fmt)
    bw.write_rules(rules, str(tmp_path / "r"), fmt)
    assert spark.read.format(fmt).load(str(tmp_path / "i")).count() == 10
    assert spark.read.format(fmt).load(str(tmp_path / "r")).count() == 11


def test_sink_modes(spark, tmp_path):
    itemsets, _ = demo(spark)
    bw.write_itemsets(itemsets, str(tmp_path / "i"), "json", ordered=False)
    with pytest.raises(Exception):
        bw.write_itemsets(itemsets, str(tmp_path / "i"), "json")
    bw.write_itemsets(itemsets, str(tmp_path / "i"), "json", mode="overwrite")
    assert len([json.loads(line) for line in lines(tmp_path / "i")]) == 10
    with pytest.raises(ValueError):
        bw.write_itemsets(itemsets, str(tmp_path / "x"), "unknown")


def run_job(spark, *argv):
    return job.mine_job(spark, job.parse_arguments([str(a) for a in argv]))


def test_job_on_text(spark, tmp_path):
    (tmp_path / "in.txt").write_text("\n".join(DEMO) + "\n")
    out = tmp_path / "out"
    found = run_job(spark, tmp_path / "in.txt", out, "fpgrowth", 2, 4, "--ordered")
    assert collected(found) == DEMO_ITEMSETS
    assert len(lines(out / "fpgrowth_itemsets")) == 10
    assert len(lines(out / "fpgrowth_rules")) == 11
    with pytest.raises(Exception):
        run_job(spark, tmp_path / "in.txt", out, "fpgrowth", 2)
    run_job(spark, tmp_path / "in.txt", out, "fpgrowth", 2, "--overwrite", "--format", "json")


def test_job_on_a_table_without_saving(spark, tmp_path):
    rows = rows_frame(spark, [line.split() for line in DEMO])
    rows.write.parquet(str(tmp_path / "rows"))
    argv = ["--key", "tid", "--item", "item", "--no-save"]
    found = run_job(spark, tmp_path / "rows", tmp_path / "out", "subsets", 2, *argv)
    assert collected(found) == DEMO_ITEMSETS
    assert not (tmp_path / "out").exists()
    with pytest.raises(SystemExit):
        job.parse_arguments(["in", "out", "eclat", "2", "--key", "tid"])
