"""Near-duplicate documents by min-max hashing.

A document is the set of its distinct shingles of five words. Each permutation of the
shingles' hashes gives two values, the least and the greatest, so half the hash
evaluations of MinHash fill a signature of the same length; both are unbiased samples
of the resemblance. Bands of equal values propose pairs; links are confirmed on the
full sets.

Equal sets become one class first. In a band's bucket every class meets the bucket's
hub, the member that meets most others in all its buckets, so a bucket gives as many
pairs as it has members. What the links join is then one component. Classes of one
bucket that are still in different components are compared with each other only where
what they share besides their hub could suffice, so that no link is lost and a group
of copies is never expanded into its pairs.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketweave.functions.joins import fits_broadcast, lookup_join
from basketweave.llm.common import Memo, held, map_batches
from basketweave.workspace import Table, Workspace

SHINGLE = 5
# Documents are linked if 100 * intersection >= SIMILARITY * union.
SIMILARITY = 75
# A pair at the threshold is missed with probability (1 - 0.75^ROWS)^BANDS: 2.3e-6.
BANDS, ROWS = 48, 5
PERMUTATIONS = BANDS * ROWS // 2
# Shingles that are hashed at once, so that they stay in the processor's cache.
CHUNK = 1 << 15
# Members of a hub that meet it in one place; an id in a broadcast table.
HUB_MEMBERS, ID_BYTES = 1000, 96

_ODD = np.random.default_rng(20).integers(1, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no pattern in them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words() -> Memo:
    """64-bit hashes of words."""
    return held("minhash", None, lambda: Memo(xxhash.xxh3_64_intdigest))


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes.

    A-Z are lower-cased and words end at ASCII white space; fewer than five words are
    one shingle, none are no shingle.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_words().__getitem__, found), np.uint64, len(found))
    size = min(SHINGLE, len(found))
    value = np.full(len(found) - size + 1, size, np.uint64)
    for i in range(size):
        value = value * _STEP + hashes[i : len(found) - size + 1 + i]
    return np.unique(_mixed(value))


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """The band keys of non-empty sets, a row for each."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    keys = np.empty((len(sets), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for half in range(BANDS // 2):
            low = np.full(len(sets), 2 * half, np.uint64)
            high = low + np.uint64(1)
            for row in range(ROWS):
                permuted = joined * _ODD[half * ROWS + row]
                low = low * _STEP + np.minimum.reduceat(permuted, starts)
                high = high * _STEP + np.maximum.reduceat(permuted, starts)
                low, high = _mixed(low), _mixed(high)
            keys[:, 2 * half], keys[:, 2 * half + 1] = low, high
    return keys


def _name(shingle_set: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, as two signed numbers."""
    name = xxhash.xxh3_128_intdigest(shingle_set.tobytes())
    return (name >> 64) - (1 << 63), (name & (1 << 64) - 1) - (1 << 63)


def _chunks(sets: list[np.ndarray]):
    chunk, size = [], 0
    for s in sets:
        if chunk and size + len(s) > CHUNK:
            yield chunk
            chunk, size = [], 0
        chunk.append(s)
        size += len(s)
    if chunk:
        yield chunk


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, a 128-bit name of the set, its band keys, a hash of the text."""

    def make():
        def step(ids, texts, hashes):
            out = {"doc_id": ids, "n_shingles": [], "set_a": [], "set_b": [], "bands": [], "text_hash": hashes}
            for at in range(0, len(ids), 256):
                sets = [shingles(t) for t in texts[at : at + 256]]
                keys = [k for c in _chunks([s for s in sets if len(s)]) for k in bands(c).view(np.int64)]
                keys = iter(keys)
                for s in sets:
                    a, b = _name(s)
                    out["n_shingles"].append(len(s))
                    out["set_a"].append(a)
                    out["set_b"].append(b)
                    out["bands"].append(next(keys) if len(s) else [])
            return out

        return step

    schema = (
        "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, "
        "text_hash bigint"
    )
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint"), text, F.xxhash64(text).alias("hash"))
    return map_batches(rows, make, schema)


def _sets(docs: DataFrame, wanted: Table) -> DataFrame:
    """The full sets of classes, ``id`` and ``set``, whose texts are read again.

    `wanted` has the ``id`` of each class, and the ``doc_id`` and ``text_hash`` of a row in
    it: an id may stand on other texts too.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    rows = wanted.df.select("id", "doc_id", "text_hash")
    rows = F.broadcast(rows) if fits_broadcast(wanted.rows, ID_BYTES) else rows

    def make():
        return lambda ids, texts: {"id": ids, "set": [shingles(t).view(np.int64) for t in texts]}

    found = texts.join(rows, ["doc_id", "text_hash"]).select("id", "text")
    return map_batches(found, make, "id bigint, set array<bigint>").dropDuplicates(["id"])


def _overlaps(pairs: DataFrame, sets: DataFrame, what: Column, hubs: DataFrame | None = None) -> DataFrame:
    """`pairs` (``hub``, ``id`` and more) with `what` of ``set`` and ``hub_set``.

    `hubs` are the sets of the hubs, ``(hub, pieces, hub_set)``, if few meet many: the
    members of a hub, dealt to its pieces as ``piece`` says, then meet a copy in each.
    """
    joined = pairs.join(sets, "id")
    if hubs is None:
        of_hub = sets.select(F.col("id").alias("hub"), F.col("set").alias("hub_set"))
        return joined.join(of_hub, "hub").select(*pairs.columns, what)
    pieces = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)).alias("piece")
    copies = hubs.select("hub", pieces, "hub_set")
    return joined.join(copies, ["hub", "piece"]).select(*pairs.columns, what)


def _shared() -> Column:
    return F.size(F.array_intersect("set", "hub_set"))


def _linked(n: str, other: str, shared: str) -> Column:
    """Whether sets of so many members that share so many are similar enough."""
    n, other, shared = F.col(n), F.col(other), F.col(shared)
    return 100 * shared >= SIMILARITY * (n + other - shared)


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """``node`` and the smallest node of its component, for all ends of `edges`.

    Every round hooks each component to the smallest one it touches, shortens the
    chains this makes by pointer jumping, and contracts the edges. Rounds write tables.
    """
    pair = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = ws.write("edges", edges.select(*pair).where("a < b").distinct())
    nodes = links.df.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = nodes.select("node", F.col("node").alias("component"))
    while links.rows:
        parents = ws.write("parents", links.df.groupBy("b").agg(F.min("a").alias("a")))
        while True:
            above = parents.df.select(F.col("b").alias("a"), F.col("a").alias("top"))
            jumped = parents.df.join(above, "a", "left").select(
                "b", F.coalesce("top", "a").alias("a"), F.col("top").isNotNull().alias("moved")
            )
            parents = ws.write("parents", jumped, moved=F.max(F.col("moved").cast("int")))
            if not parents.stats["moved"]:
                break
        up = parents.df.select(F.col("b").alias("from"), F.col("a").alias("to"))
        labels = ws.write(
            "labels",
            labels.join(up, labels["component"] == up["from"], "left").select(
                "node", F.coalesce("to", "component").alias("component")
            ),
        ).df
        moved = links.df
        for end in ("a", "b"):
            moved = moved.join(up.withColumnRenamed("from", end), end, "left").withColumn(
                end, F.coalesce("to", end)
            ).drop("to")
        links = ws.write("edges", moved.select(*pair).where("a < b").distinct())
    return labels


def _others(
    ws: Workspace,
    rows: DataFrame,
    sets: DataFrame,
    hubs: DataFrame | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Pairs that may be linked though neither is a hub: ``hub``, ``id``, ``n``, ``other``.

    `rows` are the members of all hubs' buckets with ``shared``, what each shares with
    the hub, and ``component``. Two members share at most what one of them shares with
    the hub, and the parts outside the hub that both have. So a pair that may still be
    linked either has such parts in common, or both share enough with the hub already,
    which takes a second one smaller than the hub. Both are exact. What a member shares
    with the hub says how many such parts a pair must have in common; so it is enough to
    pair members on the rarest ones, all but as many less one. `keys` (``hub``, ``id``,
    ``key``) are the buckets in which members meet their hub; with them, only members of
    one bucket are paired.
    """

    def placed(members: DataFrame) -> DataFrame:
        """Where `members` may meet: their buckets, or all of their hub's."""
        if keys is None:
            return members.withColumn("key", F.col("hub"))
        return members.join(keys, ["hub", "id"])


    of = rows.groupBy("hub").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    doubt = ws.write("doubt", rows.join(of.where("low < high").select("hub"), "hub")).df
    outside = F.explode(F.array_except("set", "hub_set")).alias("part")
    columns = ["hub", "id", "component"] + (["piece"] if hubs is not None else [])
    every = ws.write("parts", _overlaps(doubt.select(*columns), sets, outside, hubs).drop("piece"))
    parts = every.df

    def foreign(parts: DataFrame) -> DataFrame:
        """The parts that members of different components have, and how many have each."""
        of = parts.drop("members").groupBy("hub", "part").agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count(F.lit(1)).alias("members"),
        )
        shared = of.where("low < high").select("hub", "part", "members")
        return parts.drop("members").join(shared, ["hub", "part"])

    parts = ws.write("foreign", foreign(parts)).df
    ws.drop(every)
    most = parts.groupBy("hub", "id").agg(F.count(F.lit(1)).alias("more"))
    least = doubt.groupBy("hub").agg(F.min("n").alias("least"))
    smallest = F.greatest(F.col("least"), F.ceil(F.col("n") * SIMILARITY / 100))
    reach = F.col("shared") + F.coalesce("more", F.lit(0))
    hopeful = (
        doubt.join(least, "hub")
        .join(most, ["hub", "id"], "left")
        .where((100 + SIMILARITY) * reach >= SIMILARITY * (F.col("n") + smallest))
        .select(*doubt.columns, "least")
    )
    hopeful = ws.write("hopeful", hopeful).df
    kept = foreign(parts.join(hopeful.select("hub", "id", "n", "shared", "least"), ["hub", "id"]))
    # What the smallest possible partner must have in common with a member, less the hub's.
    overlap = F.ceil(SIMILARITY * (F.col("n") + smallest) / (100 + SIMILARITY))
    needed = F.greatest(overlap - F.col("shared"), F.lit(1))
    member = W.partitionBy("hub", "id")
    rarest = kept.select(
        "*",
        F.row_number().over(member.orderBy("members", "part")).alias("place"),
        F.count(F.lit(1)).over(member).alias("held"),
    ).where(F.col("place") <= F.col("held") - needed + 1)
    rarest = placed(rarest.select("hub", "part", "id", "n", "component"))
    rarest = ws.write("rarest", rarest.drop("hub")).df
    left, right = rarest.alias("l"), rarest.alias("r")
    sizes = 100 * F.least("l.n", "r.n") >= SIMILARITY * F.greatest("l.n", "r.n")
    pair = (
        F.greatest("l.id", "r.id").alias("hub"),
        F.least("l.id", "r.id").alias("id"),
    )
    together = left.join(
        right,
        (F.col("l.key") == F.col("r.key"))
        & (F.col("l.part") == F.col("r.part"))
        & (F.col("l.component") < F.col("r.component"))
        & sizes,
    ).select(*pair)
    # Few members share so much with a hub that they miss only by their own or its size.
    enough = (100 + SIMILARITY) * F.col("shared") >= SIMILARITY * (F.col("n") + F.col("least"))
    left = placed(hopeful.where(enough & ~_linked("n", "hub_n", "shared"))).alias("l")
    right = placed(hopeful.where(enough & (F.col("n") < F.col("hub_n")))).alias("r")
    both = (100 + SIMILARITY) * F.least("l.shared", "r.shared") >= SIMILARITY * (
        F.col("l.n") + F.col("r.n")
    )
    small = left.join(
        right,
        (F.col("l.key") == F.col("r.key")) & (F.col("l.component") != F.col("r.component")) & both,
    ).select(*pair)
    return together.unionAll(small).distinct()


def near_duplicates(docs: DataFrame, ws: Workspace) -> DataFrame:
    """Per document the size of its set and the group of near copies that it is in.

    ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id that links reach,
    itself included) and ``kept``, whether that is its own. A null or empty text has an
    empty set, and it, like a row without an id (component null, kept), is linked with
    nothing. Rows that share an id are one document if their sets are equal; each row
    comes out. Other columns are ignored; an empty table gives an empty frame.
    """
    found = _grouped(docs, ws)
    return found.drop("text_hash")


def _grouped(docs: DataFrame, ws: Workspace) -> DataFrame:
    """`near_duplicates` with a hash of each row's text."""
    signed = ws.write("signatures", signatures(docs))
    all_docs = signed.df
    named = all_docs.where("n_shingles > 0 AND doc_id IS NOT NULL")
    name = ["set_a", "set_b"]
    # A class is named by a number of its own, as an id may stand on several texts.
    classes = ws.write(
        "classes",
        named.groupBy(*name)
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("least"), F.first("n_shingles").alias("n"))
        .select(*name, "least.*", "n", F.monotonically_increasing_id().alias("id")),
    ).df
    banded = (
        named.join(classes.select("doc_id", "text_hash", "id", "n"), ["doc_id", "text_hash"])
        .dropDuplicates(["id"])
        .select("id", "n", F.explode("bands").alias("key"))
    )
    sizes = banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    in_buckets = ws.write("shared", banded.join(sizes, "key"))
    shared = in_buckets.df
    degrees = shared.groupBy("id").agg(F.sum("size").alias("degree"))
    central = F.max_by(F.struct("id", "n"), F.struct("degree", -F.col("id")))
    hubs = shared.join(degrees, "id").groupBy("key").agg(central.alias("hub"))
    buckets = ws.write(
        "buckets",
        shared.join(hubs, "key").select(
            "key", "id", "n", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n")
        ),
    ).df

    ws.drop(in_buckets)
    members = buckets.where("hub <> id")
    of_hub = members.groupBy("hub").agg(
        F.ceil(F.count_distinct("id") / HUB_MEMBERS).alias("pieces")
    )
    dealt = ws.write("pieces", of_hub)
    met = lookup_join(
        members.drop("key").distinct(), dealt.df, "hub", dealt.rows, ID_BYTES, ["id"]
    )
    piece = F.pmod(F.xxhash64("id"), F.col("pieces")).alias("piece")
    met = ws.write("met", met.select("hub", "id", "n", "hub_n", piece))
    wanted = ws.write("ids", classes.join(buckets.select("id").distinct(), "id", "left_semi"))
    sets = ws.write("sets", _sets(docs, wanted)).df
    own = sets.select(F.col("id").alias("hub"), F.col("set").alias("hub_set"))
    hub_sets = ws.write("hub_sets", dealt.df.join(own, "hub")).df
    measured = ws.write("measured", _overlaps(met.df, sets, _shared().alias("shared"), hub_sets)).df
    ws.drop(met)

    links = measured.where(_linked("n", "hub_n", "shared")).select(
        F.col("hub").alias("a"), F.col("id").alias("b")
    )
    groups = components(ws, links)
    labelled = measured.join(groups, measured["id"] == groups["node"], "left").select(
        *measured.columns, F.coalesce("component", "id").alias("component")
    )
    others = _overlaps(
        _others(ws, labelled, sets, hub_sets, members.select("hub", "id", "key")),
        sets,
        F.struct(
            F.size("set").alias("n"), F.size("hub_set").alias("other"), _shared().alias("shared")
        ).alias("sizes"),
    ).select("hub", "id", "sizes.*")
    more = others.where(_linked("n", "other", "shared")).select(
        F.col("hub").alias("a"), F.col("id").alias("b")
    )
    more = ws.write("more_links", more)
    if more.rows:
        groups = components(ws, links.unionAll(more.df))

    labelled = classes.join(groups, classes["id"] == groups["node"], "left").select(
        *name, "doc_id", F.coalesce("component", "id").alias("component")
    )
    least = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    found = ws.write("found", labelled.join(least, "component").select(*name, "component_id"))
    apart = all_docs.where("n_shingles = 0 OR doc_id IS NULL").withColumn("component_id", F.col("doc_id"))
    columns = [
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        "text_hash",
    ]
    key = F.struct(*name).alias("name")
    keyed = named.select(key, "doc_id", "n_shingles", "text_hash")
    of = found.df.select(key, "component_id")
    grouped = lookup_join(keyed, of, "name", found.rows, ID_BYTES, ["doc_id", "text_hash"])
    return grouped.select(*columns).unionAll(apart.select(*columns))


def deduplicate(docs: DataFrame, ws: Workspace) -> DataFrame:
    """One document of each group of near copies, with all columns.

    The one with the smallest id stays; rows without an id all stay. A row is dropped for
    its own text: another text under the same id stays, if it is no copy.
    """
    copies = _grouped(docs, ws).where(~F.col("kept")).select("doc_id", "text_hash")
    dropped = ws.write("copies", copies.distinct().toDF("_copy", "_copied"))
    found = F.broadcast(dropped.df) if fits_broadcast(dropped.rows, ID_BYTES) else dropped.df
    same = F.xxhash64(docs["text"].cast("string")) == found["_copied"]
    return docs.join(found, (docs["doc_id"] == found["_copy"]) & same, "left_anti")
