"""Verdicts on URLs: rules first, then trust that spreads over the link graph.

A rule names a host with all its subdomains and the beginning of a path. Where rules
are silent, hosts decide: trust starts at the hosts with allowed pages and follows the
links (personalised PageRank); distrust starts at those with blocked pages and goes
back to whoever links there. A host with more distrust than trust is blocked.

All of it is DataFrame code. The links are reduced to counted host pairs at once, so
the iterations work on hosts; they write their tables and stop when little changes.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketweave.functions.joins import lookup_join
from basketweave.workspace import Workspace

DAMPING = 0.85
# Rounds that the SQL repeats; propagate() goes on until the ranks have converged.
MAX_ROUNDS = 20
# The iterations stop when the ranks change by less than this in sum and reach no new host.
TOLERANCE = 1e-6
# A host is blocked if its distrust is more than this share of its trust and distrust.
LIMIT = 0.5
HOST_BYTES = 96

ABSOLUTE = r"^([A-Za-z][A-Za-z0-9+.\-]*:)?//"
LINK = r"""(?i)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    """What holds for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of ``text`` and ``verdict``, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text, r.verdict))
    if not ordered:
        return F.lit(None).cast("struct<verdict:string,host:string,path:string,text:string>")
    table = F.array(
        *[
            F.struct(*[F.lit(getattr(r, n)).alias(n) for n in ("verdict", "host", "path", "text")])
            for r in ordered
        ]
    )
    dotted = F.concat(F.lit("."), host)
    fits = F.filter(
        table,
        lambda r: F.endswith(dotted, F.concat(F.lit("."), r["host"])) & F.startswith(path, r["path"]),
    )
    return F.get(fits, 0)


def host_links(pages: DataFrame) -> DataFrame:
    """``src``, ``dst`` and ``n``: the links of `pages` between different hosts.

    A link names a host if it begins with ``//`` or a scheme and ``://``; any other one
    stays on its host, whatever stands in its path or query.
    """
    links = F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    full = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("x:"), F.col("link"))).otherwise(
        F.col("link")
    )
    return (
        pages.select(host_of(F.col("url")).alias("src"), links.alias("link"))
        .where(F.col("link").rlike(ABSOLUTE))
        .select("src", host_of(full).alias("dst"))
        .where("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def propagate(ws: Workspace, seeds: DataFrame, links: DataFrame) -> DataFrame:
    """``host``, ``trust`` and ``distrust`` of all hosts of `seeds` and `links`.

    `seeds` has ``host`` and the weights ``good`` and ``bad``. Trust that reaches a host
    without links, or distrust one that nobody links to, starts again at the seeds. The
    sums of both stay 1, or 0 without a seed. Damping shrinks the changes from round to
    round, so no number of rounds is set.
    """
    links = ws.write("links", links)
    ends = links.df.select(F.col("src").alias("host")).unionAll(links.df.select("dst"))
    empty = ends.distinct().select("host", F.lit(0.0).alias("good"), F.lit(0.0).alias("bad"))
    good, bad = seeds.agg(F.sum("good"), F.sum("bad")).first()
    start = ws.write(
        "hosts",
        seeds.select("host", F.col("good") / F.lit(good or 1.0), F.col("bad") / F.lit(bad or 1.0))
        .unionAll(empty)
        .toDF("host", "good", "bad")
        .groupBy("host")
        .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")),
    ).df
    outgoing = links.df.groupBy("src").agg(F.sum("n").alias("out"))
    incoming = links.df.groupBy("dst").agg(F.sum("n").alias("into"))
    edges = ws.write(
        "weights",
        links.df.join(outgoing, "src")
        .join(incoming, "dst")
        .select(
            "src",
            "dst",
            (F.col("n") / F.col("out")).alias("go"),
            (F.col("n") / F.col("into")).alias("back"),
        ),
    ).df
    none = F.lit(0.0)
    ranks = start.select("host", F.col("good").alias("trust"), F.col("bad").alias("distrust"))
    old_table, reached = None, -1
    while links.rows:
        forward = edges.join(ranks, edges["src"] == ranks["host"]).select(
            F.col("dst").alias("host"), (F.col("trust") * F.col("go")).alias("t"), none.alias("d")
        )
        backward = edges.join(ranks, edges["dst"] == ranks["host"]).select(
            F.col("src").alias("host"), none.alias("t"), (F.col("distrust") * F.col("back")).alias("d")
        )
        moved = ws.write(
            "moved",
            forward.unionAll(backward).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d")),
            t=F.sum("t"),
            d=F.sum("d"),
        )
        lost_t = (1 - moved.stats["t"]) if good else 0.0
        lost_d = (1 - moved.stats["d"]) if bad else 0.0
        trust = DAMPING * F.coalesce("t", none) + (1 - DAMPING + DAMPING * lost_t) * F.col("good")
        distrust = DAMPING * F.coalesce("d", none) + (1 - DAMPING + DAMPING * lost_d) * F.col("bad")
        change = F.abs(F.col("trust") - F.col("old_t")) + F.abs(F.col("distrust") - F.col("old_d"))
        old = ranks.select("host", F.col("trust").alias("old_t"), F.col("distrust").alias("old_d"))
        table = ws.write(
            "ranks",
            start.join(moved.df, "host", "left")
            .select("host", trust.alias("trust"), distrust.alias("distrust"))
            .join(old, "host"),
            change=F.sum(change),
            reached=F.sum((F.col("trust") > 0).cast("int") + (F.col("distrust") > 0).cast("int")),
        )
        ws.drop(moved)
        if old_table:
            ws.drop(old_table)
        ranks, old_table = table.df.drop("old_t", "old_d"), table
        if table.stats["change"] < TOLERANCE and table.stats["reached"] == reached:
            break
        reached = table.stats["reached"]
    return ranks


def judge(
    pages: DataFrame, ws: Workspace, rules: Sequence[Rule], limit: float = LIMIT
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every page.

    `pages` has ``page_id``, ``url`` and ``html``; other columns are ignored. A url that
    is null or lacks ``://`` has an empty host, which takes no part in the graph. A page
    without a rule has its host's verdict, and is allowed where nothing is known of the
    host. Repeated pages count each. An empty table gives an empty frame; a null html
    has no links.
    """
    judged = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = judged.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.col("found.verdict")
    seeds = (
        judged.where("host <> ''")
        .groupBy("host")
        .agg(
            F.sum(F.when(verdict == "allow", 1.0).otherwise(0.0)).alias("good"),
            F.sum(F.when(verdict == "block", 1.0).otherwise(0.0)).alias("bad"),
        )
    )
    ranks = propagate(ws, ws.write("seeds", seeds).df, host_links(pages))
    blocked = (F.col("distrust") > 0) & (
        F.col("distrust") > F.lit(limit) * (F.col("trust") + F.col("distrust"))
    )
    known = ws.write(
        "verdicts",
        ranks.select("host", F.when(blocked, "block").otherwise("allow").alias("of_host"))
        .unionAll(ws.spark.range(1).select(F.lit(""), F.lit("allow"))),
    )
    return lookup_join(judged, known.df, "host", known.rows, HOST_BYTES, ["page_id"]).select(
        "page_id",
        "host",
        "path",
        F.col("found.text").alias("rule"),
        F.coalesce(verdict, "of_host").alias("verdict"),
    )
