"""URL verdicts from rules and, where no rule fits, from trust carried over the host graph.

Trust is a personalised PageRank from the hosts of allowed pages over links; distrust is one from the
hosts of blocked pages over reversed links. Everything is a DataFrame expression, grouping or join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.runtime import materialize

DAMPING = 0.85
ROUNDS = 20
# A host without a rule is blocked when its distrust is more than this many times its trust.
RATIO = 2.0
_ROUNDS_PER_TABLE = 4  # rounds between two written tables, which cut the lineage
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# A link to a host, with or without its scheme.
_LINK = r"""(?i)\bhref\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?(//[^"'\s>]+)"""
# The longest name that a host may have; longer ones belong to no site.
LONGEST_HOST = 253


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path begins with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host to the next ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def ruling(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest fitting rule as (``rule``, ``verdict``), null if none fits. ``rules`` is configuration."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    # the longest rule is tested first; rules of one length in the order of their names
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def sites_of(host: Column) -> Column:
    """(``src``, ``dst``) of the host and every domain above it with the next one, down to two labels.

    Empty where there is no domain above, a label is empty or the name is longer than a host's may be.
    """
    labels = F.split(host, r"\.")
    n = F.size(labels)
    name = lambda i: F.array_join(F.slice(labels, i, n), ".")
    steps = F.transform(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))), lambda i: F.struct(name(i).alias("src"), name(i + 1).alias("dst")))
    whole = (n > 2) & ~F.array_contains(labels, "") & (F.char_length(host) <= LONGEST_HOST)
    return F.when(whole, steps)


def host_links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Links between different hosts with their number: (``src``, ``dst``, ``weight``).

    Links come from hrefs that name a host, with a scheme or as ``//host/``. A subdomain and the domain above it belong
    to one site and are joined by an edge of weight 1 each way, at every level down to two labels. Counts are combined before the shuffle, so a host with very many pages
    is one row per link target and task.
    """
    links = pages.select(host_of(F.col(url)).alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(_LINK), F.lit(1))).alias("to"))
    links = links.select("src", host_of(F.concat(F.lit(":"), F.col("to"))).alias("dst")).filter("src <> '' AND dst <> '' AND src <> dst")
    links = materialize(links.groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight")), "host-links")
    hosts = pages.select(host_of(F.col(url)).alias("h")).union(links.select(F.col("dst").alias("h"))).filter("h <> ''")
    hosts = hosts.distinct()
    up = hosts.select(F.explode(sites_of(F.col("h"))).alias("x")).select("x.*").distinct()
    site = up.union(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("weight", F.lit(1.0))
    return links.union(site).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(links: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank of both kinds: (``kind``, ``host``, ``rank``) of hosts that mass reaches.

    ``links`` is (kind, src, dst, weight), ``seeds`` (kind, host, start) with starts that add up to 1 in
    a kind. Mass at a host without links goes nowhere.
    """
    out = links.groupBy("kind", "src").agg(F.sum("weight").alias("out"))
    share = links.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("out")).alias("share"))
    share = materialize(share, "host-shares")
    seeds = materialize(seeds, "host-seeds")
    ranks = seeds.select("kind", "host", F.col("start").alias("rank"))
    base = seeds.select("kind", "host", (F.col("start") * (1 - damping)).alias("part"))
    for i in range(rounds):
        sent = ranks.join(share, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("part"))
        ranks = base.union(sent).groupBy("kind", "host").agg(F.sum("part").alias("rank"))
        if (i + 1) % _ROUNDS_PER_TABLE == 0 or i + 1 == rounds:
            ranks = materialize(ranks, "host-ranks")
    return ranks


def judge(
    pages: DataFrame,
    rules: list[Rule],
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    ratio: float = RATIO,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule``, ``verdict``, ``trust`` and ``distrust`` of the host.

    The seeds are the hosts of pages that a rule allows or blocks, in proportion to those pages. Without
    a rule a page is blocked if its host's distrust is more than ``ratio`` times its trust, else allowed; so
    is a page without a host, and every page when no link or site leads to a seed. Null urls
    and texts are empty; repeated rows come out as often; extra columns are not read.
    """
    parsed = pages.select(F.col(page_id).alias("id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    parsed = parsed.withColumn("ruling", ruling(F.col("host"), F.col("path"), rules))
    parsed = parsed.select("id", "host", "path", "ruling.rule", "ruling.verdict")

    kind = F.when(F.col("verdict") == "allow", "trust").otherwise("distrust").alias("kind")
    counted = parsed.filter("verdict IS NOT NULL AND host <> ''").groupBy(kind, "host").agg(F.count("*").alias("n"))
    total = counted.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = counted.join(total, "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("start"))

    links = host_links(pages, url, html)
    forward = links.select(F.lit("trust").alias("kind"), "src", "dst", "weight")
    backward = links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    ranks = propagate(forward.union(backward), seeds, rounds)

    def of(kind: str) -> Column:
        # rounded, so that the order of summation decides no verdict
        return F.round(F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)), 9).alias(kind)

    hosts = ranks.groupBy("host").agg(of("trust"), of("distrust"))
    # a host with very many pages is one key: adaptive execution splits its rows
    scored = parsed.join(hosts, "host", "left").fillna(0.0, ["trust", "distrust"])
    method = F.when(F.col("distrust") > ratio * F.col("trust"), "block").otherwise("allow")
    return scored.select(
        F.col("id").alias(page_id), "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), "trust", "distrust"
    )
