"""WARC archives and their fixity, audited with Merkle trees.

Pages are written as gzipped WARC files, one member per record, with a ledger of each
record's place. The fixity of a replica is a tree per file: leaves are hashes of the
records' bytes, and a node hashes its children's hashes with the ordered offset ranges
that they cover. To compare two replicas, roots are joined first, and only below
mismatching nodes are children looked at, so an intact file costs one comparison.

Every node has at most FANOUT children; levels are tables, so a tree is built by Spark
in as many small steps as it is deep.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketweave.llm.common import map_arrow
from basketweave.workspace import Workspace

FANOUT = 16
# A file takes no further record beyond this size.
FILE_BYTES = 256 << 20
# Bytes that are copied at once.
COPY_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"

LEDGER = "file string, seq long, page_id long, start long, end long, sha256 string"
LEAF = "file string, node long, start long, end long, hash string"


def record(page_id: int | None, url: str | None, html: str | None) -> bytes:
    """A response record; a null url or html is empty, line ends in a url are escaped."""
    body = (html or "").encode("utf-8", "surrogatepass")
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    name = hashlib.md5(f"{page_id}|{target}".encode()).hexdigest()
    urn = "-".join([name[:8], name[8:12], name[12:16], name[16:20], name[20:]])
    head = (
        "WARC/1.1\r\nWARC-Type: response\r\n"
        f"WARC-Record-ID: <urn:uuid:{urn}>\r\nWARC-Date: {DATE}\r\n"
        f"WARC-Target-URI: {target}\r\nContent-Type: text/html\r\n"
        f"Content-Length: {len(body)}\r\n\r\n"
    )
    return head.encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """The header fields and the body of a gzipped record."""
    head, _, rest = gzip.decompress(data).partition(b"\r\n\r\n")
    fields = dict(
        line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    )
    return fields, rest[: int(fields["Content-Length"])]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    columns = [c.split() for c in schema.split(", ")]
    arrays = [pa.array([r[i] for r in rows], kinds[t]) for i, (_, t) in enumerate(columns)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in columns])


def write_archive(pages: DataFrame, ws: Workspace, folder: str) -> DataFrame:
    """Write `pages` (``page_id``, ``url``, ``html``) to WARC files and return the ledger.

    Each task writes files of its own, in the order of its rows. The ledger has one row
    per page: ``file``, its place ``seq``, ``start`` and ``end`` in bytes and the hash of
    its stored bytes. Files that a lost task leaves are not in it. Repeated pages are
    records each; an empty table gives an empty ledger. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        out, name, at, seq, number = None, "", 0, 0, 0
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    store.create_dir(root, recursive=True)
                    name = f"{context.partitionId():06d}-{context.taskAttemptId()}-{number}.warc.gz"
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    at, seq, number = 0, 0, number + 1
                data = gzip.compress(record(page_id, url, html), 6, mtime=0)
                out.write(data)
                rows.append((name, seq, page_id, at, at + len(data), hashlib.sha256(data).hexdigest()))
                at, seq = at + len(data), seq + 1
                if at >= FILE_BYTES:
                    out.close()
                    out = None
            yield _batch(rows, LEDGER)
        if out is not None:
            out.close()

    columns = [F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string")]
    return ws.write("ledger", map_arrow(pages.select(*columns), run, LEDGER)).df


def copy_archive(ledger: DataFrame, ws: Workspace, source: str, target: str, drill: int = 0) -> None:
    """Copy the files of `ledger` from one folder to another, a file per task.

    With `drill`, the copy is damaged on purpose: one byte is changed in the middle of
    each record whose ``page_id`` has a CRC divisible by `drill`.
    """
    hit = F.crc32(F.col("page_id").cast("string")) % drill == 0 if drill else F.lit(False)
    files = ledger.groupBy("file").agg(
        F.collect_list(F.when(hit, F.expr("start + (end - start) div 2"))).alias("bytes")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (here, root), (there, goal) = fs.FileSystem.from_uri(source), fs.FileSystem.from_uri(target)
        for batch in batches:
            for name, flips in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                there.create_dir(goal, recursive=True)
                at, flips = 0, sorted(flips)
                with (
                    here.open_input_stream(f"{root}/{name}", compression=None) as old,
                    there.open_output_stream(f"{goal}/{name}", compression=None) as new,
                ):
                    while data := bytearray(old.read(COPY_BYTES)):
                        while flips and flips[0] < at + len(data):
                            data[flips.pop(0) - at] ^= 0xFF
                        new.write(bytes(data))
                        at += len(data)
                yield _batch([(name, at)], "file string, size long")

    rows = ws.write("to_copy", files)
    ws.write("copied", map_arrow(rows.df.repartition(max(1, rows.rows)), run, "file string, size long"))


def _digest(file, start: int, end: int | None) -> str:
    """The hash of a file's bytes from `start` to `end`, or to where the file ends."""
    file.seek(start)
    found, left = hashlib.sha256(), end
    while data := file.read(COPY_BYTES if left is None else min(COPY_BYTES, left - start)):
        found.update(data)
        start += len(data)
    return found.hexdigest()


def hash_records(ledger: DataFrame, folder: str) -> DataFrame:
    """The leaves of a replica: for each record of `ledger` the hash of its bytes in `folder`.

    Every byte is in a leaf: that of a record begins where the record before it ends, and
    that of the last one goes on to the end of the file. A file in the folder that the
    ledger does not have is a leaf of its own. What is missing from a file, or a missing
    file, hashes as what is there. Files are read in parallel, each in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        name, file = None, io.BytesIO()
        for batch in batches:
            rows = []
            for of, seq, start, end, begin, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if of != name:
                    file.close()
                    info = store.get_file_info(f"{root}/{of}")
                    missing = info.type != fs.FileType.File
                    name, file = of, io.BytesIO() if missing else store.open_input_file(f"{root}/{of}")
                rows.append((of, seq, start, end, _digest(file, begin, stop)))
            yield _batch(rows, LEAF)
        file.close()

    order = W.partitionBy("file").orderBy("seq")
    places = ledger.select(
        "file",
        "seq",
        "start",
        "end",
        F.coalesce(F.lag("end").over(order), F.lit(0)).alias("begin"),
        F.when(F.lead("seq").over(order).isNotNull(), F.col("end")).alias("stop"),
    )
    return map_arrow(places.unionAll(_strays(ledger, folder)), run, LEAF)


def _strays(ledger: DataFrame, folder: str) -> DataFrame:
    """The files in a folder that are not in `ledger`, as one place each.

    Names that begin with a dot or an underscore do not count, as Spark reads none.
    """
    spark = ledger.sparkSession
    store, root = fs.FileSystem.from_uri(folder)
    nothing = "file string, seq long, start long, end long, begin long, stop long"
    if store.get_file_info(root).type != fs.FileType.Directory:
        return spark.createDataFrame([], nothing)
    zero = F.lit(0).cast("bigint")
    listed = spark.read.format("binaryFile").load(folder).select(
        F.substring_index("path", "/", -1).alias("file"), F.col("length").alias("end")
    )
    return listed.join(ledger.select("file").distinct(), "file", "left_anti").select(
        "file", zero.alias("seq"), zero.alias("start"), "end", zero.alias("begin"), F.lit(None).cast("bigint").alias("stop")
    )


@dataclass(frozen=True)
class Tree:
    """The levels of a replica's trees, leaves first; the last has one node per file."""

    levels: list[DataFrame]


def build_tree(leaves: DataFrame, ws: Workspace) -> Tree:
    """Hash `leaves` (``file``, ``node``, ``start``, ``end``, ``hash``) up to the roots."""
    table = ws.write("level", leaves, top=F.max("node"))
    levels = [table.df]
    while table.stats["top"] > 0:
        child = F.struct("node", "start", "end", "hash")
        children = F.array_sort(F.collect_list(child))
        text = F.array_join(
            F.transform(children, lambda c: F.concat_ws(":", c["start"], c["end"], c["hash"])), "|"
        )
        parents = (
            levels[-1]
            .groupBy("file", F.expr(f"node div {FANOUT}").alias("node"))
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sha2(text, 256).alias("hash"))
        )
        table = ws.write("level", parents, top=F.max("node"))
        levels.append(table.df)
    return Tree(levels)


def audit(one: Tree, other: Tree, ws: Workspace) -> DataFrame:
    """The records in which two replicas differ: ``file``, ``node``, ``start``, ``end``.

    The trees stand over the same ledger; a file that only one replica has beyond it
    differs, too. Below the roots, only children of nodes that differ are compared.
    """
    suspects = None
    for a, b in zip(reversed(one.levels), reversed(other.levels), strict=True):
        if suspects is not None:
            parent = F.expr(f"node div {FANOUT}")
            above = suspects.select("file", F.col("node").alias("parent"))
            a, b = (
                x.withColumn("parent", parent).join(above, ["file", "parent"], "left_semi")
                for x in (a, b)
            )
        same = ["file", "node", "start", "end", "hash"]
        a, b = a.select(*same), b.select(*same)
        differ = a.join(b, same, "left_anti").unionAll(b.join(a, same, "left_anti"))
        places = F.min("start").alias("start"), F.max("end").alias("end")
        suspects = ws.write("suspects", differ.groupBy("file", "node").agg(*places)).df
    return suspects.select("file", "node", "start", "end")
