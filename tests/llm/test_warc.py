"""Archives, their trees and damage to replicas."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from basketweave.llm import warc
from basketweave.workspace import Workspace
from tests.llm.conftest import with_clashes

PAGE = "page_id BIGINT, url STRING, html STRING"


def local(uri):
    return Path(uri.removeprefix("file://"))


@pytest.fixture(scope="module")
def archive(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", "é<p>" * rng.randint(0, 200)) for i in range(700)]
    rows += [(None, None, None), (5, "a\r\nb", "\r\n\r\n"), (5, "a\r\nb", "\r\n\r\n")]
    pages = with_clashes(spark.createDataFrame(rows, PAGE)).repartition(3)
    ws = Workspace(spark)
    folder = f"{ws.path}/one"
    return rows, ws, folder, warc.write_archive(pages, ws, folder)


def test_records_read_back(archive):
    rows, _, folder, ledger = archive
    found = []
    for r in ledger.collect():
        data = (local(folder) / r["file"]).read_bytes()[r["start"] : r["end"]]
        fields, body = warc.parse(data)
        found.append((r["page_id"], fields["WARC-Target-URI"], body.decode()))
    expected = [(i, (u or "").replace("\r", "%0D").replace("\n", "%0A"), h or "") for i, u, h in rows]
    assert sorted(found, key=str) == sorted(expected, key=str)
    for r in ledger.groupBy("file").agg(F.max("end").alias("end")).collect():
        assert (local(folder) / r["file"]).stat().st_size == r["end"]


def damaged(archive, spark, hurt):
    """The records found in a copy that `hurt` has changed, and those that differ."""
    _, ws, folder, ledger = archive
    own = Workspace(spark)
    copy = f"{own.path}/two"
    warc.copy_archive(ledger, own, folder, copy)
    hurt(local(copy), ledger)
    trees = [warc.build_tree(warc.hash_records(ledger, f), own) for f in (folder, copy)]
    found = {(r["file"], r["node"]) for r in warc.audit(*trees, own).collect()}
    differ = set()
    for r in ledger.collect():
        one = (local(folder) / r["file"]).read_bytes()[r["start"] : r["end"]]
        path = local(copy) / r["file"]
        two = path.read_bytes()[r["start"] : r["end"]] if path.exists() else None
        if one != two:
            differ.add((r["file"], r["seq"]))
    return found, differ


def flip(path, places):
    data = bytearray(path.read_bytes())
    for at in places:
        data[at] ^= 1
    path.write_bytes(bytes(data))


def test_an_intact_copy(archive, spark):
    assert damaged(archive, spark, lambda *_: None) == (set(), set())


def test_flipped_bytes_are_located(archive, spark):
    def hurt(folder, ledger):
        for path in sorted(folder.glob("*.gz"))[:2]:
            size = path.stat().st_size
            flip(path, [0, size // 3, size - 1])

    found, differ = damaged(archive, spark, hurt)
    assert found == differ and len(found) >= 5


def test_cut_and_missing_files(archive, spark):
    def hurt(folder, ledger):
        first, second, *_ = sorted(folder.glob("*.gz"))
        first.write_bytes(first.read_bytes()[: first.stat().st_size // 2])
        second.unlink()

    found, differ = damaged(archive, spark, hurt)
    assert found == differ and len(found) > 200


def test_bytes_and_files_outside_the_ledger(archive, spark):
    places = []

    def hurt(folder, ledger):
        path = sorted(folder.glob("*.gz"))[0]
        path.write_bytes(path.read_bytes() + b"more")
        (folder / "stray.bin").write_bytes(b"x" * 10)
        last = ledger.where(F.col("file") == path.name).agg(F.max("seq")).first()[0]
        places.extend([(path.name, last), ("stray.bin", 0)])

    found, differ = damaged(archive, spark, hurt)
    assert not differ and found == set(places)


def test_bytes_between_records(archive, spark):
    """A ledger that leaves some records out; their bytes are still audited."""
    rows, ws, folder, ledger = archive
    sparse = ledger.where("seq % 5 <> 2")
    found, _ = damaged((rows, ws, folder, sparse), spark, lambda at, _: [
        flip(at / r["file"], [r["start"]]) for r in ledger.where("seq = 7").collect()
    ])
    assert found == {(r["file"], 8) for r in ledger.where("seq = 7").collect()}


def test_a_very_long_page(spark, monkeypatch):
    monkeypatch.setattr(warc, "COPY_BYTES", 1 << 16)
    ws = Workspace(spark)
    pages = spark.createDataFrame([(1, "u", "".join(map(str, range(200_000)))), (2, "v", "short")], PAGE).coalesce(1)
    ledger = warc.write_archive(pages, ws, f"{ws.path}/one")
    rows = {r["node"]: r["hash"] for r in warc.hash_records(ledger, f"{ws.path}/one").collect()}
    assert rows == {r["seq"]: r["sha256"] for r in ledger.collect()}


def test_the_drill(archive, spark):
    from zlib import crc32

    _, ws, folder, ledger = archive
    copy = f"{Workspace(spark).path}/drill"
    warc.copy_archive(ledger, ws, folder, copy, drill=7)
    trees = [warc.build_tree(warc.hash_records(ledger, f), ws) for f in (folder, copy)]
    bad = warc.audit(*trees, ws).join(
        ledger.select("file", F.col("seq").alias("node"), "page_id"), ["file", "node"]
    )
    expected = [r["page_id"] for r in ledger.collect() if r["page_id"] is not None and crc32(str(r["page_id"]).encode()) % 7 == 0]
    assert sorted(r["page_id"] for r in bad.collect()) == sorted(expected)


def test_trees_are_narrow(archive):
    _, ws, folder, ledger = archive
    tree = warc.build_tree(warc.hash_records(ledger, folder), ws)
    files = ledger.select("file").distinct().count()
    assert [x.count() for x in tree.levels][0] == 703 and tree.levels[-1].count() == files
    assert len(tree.levels) == 3


def test_empty_table(spark, ws):
    pages = spark.createDataFrame([], PAGE)
    ledger = warc.write_archive(pages, ws, f"{ws.path}/none")
    warc.copy_archive(ledger, ws, f"{ws.path}/none", f"{ws.path}/copy")
    tree = warc.build_tree(warc.hash_records(ledger, f"{ws.path}/none"), ws)
    assert warc.audit(tree, tree, ws).collect() == []
