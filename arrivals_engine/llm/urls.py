"""URL filters: rules on host and path, and trust and distrust spread over host links.

A rule fits its host and all subdomains if the path begins with the rule's; of several that
fit, the longest wins. Pages that no rule judges are judged by their host: a personalised
PageRank from the hosts of allowed pages flows along the links between hosts, and one from
the hosts of blocked pages flows against them, as who links to blocked hosts earns distrust.
Ranks are counted in pages: those that restart at a host are its judged pages, so pages
without links to it change nothing for it. They go round until no host's
rank changes by more than ``settled`` pages; a rank below that may be missing. A host is blocked if its distrust then exceeds ``ratio`` times its trust and ``floor``
pages. The columns trust and distrust are the ranks after ``rounds`` rounds, as a share of all
judged pages of the kind, to 12 digits.

Links are the absolute addresses in a page; a host is also linked, both ways, with the
host that its name is a direct subdomain of, if that has two labels or more. Links are counted
per pair of hosts before anything is shuffled, and ranks are written each few rounds.

Defined results: a url that is null or has no :// has an empty host and path, which no rule
fits and nothing links to: it is allowed. Null html has no links. Repeated rows each count
and each get their row; other columns are not read. Without pages there are no rows. Links of a
very long page are one row's array.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivals_engine.llm.common import Scratch, lower_ascii


EDGES_OF_A_TASK = 250_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _after_scheme(url: Column) -> Column:
    known = F.coalesce(url, F.lit(""))
    at = F.instr(known, "://")
    return F.when(at > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise("")


def host_of(rest: Column) -> Column:
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def with_address(pages: DataFrame, *more: str) -> DataFrame:
    """page_id, html, host and path, and more columns of pages."""
    rest = F.col("_rest")
    return (
        pages.select("page_id", "html", *more, F.coalesce("url", F.lit("")).alias("_url"))
        .withColumn("_rest", _after_scheme(F.col("_url")))
        .select("page_id", "html", *more, host_of(rest).alias("host"), path_of(rest).alias("path"))
    )


def rule_that_fits(rules: list[Rule]) -> Column:
    """The text and verdict of the longest rule that fits columns host and path, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        inside = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        mine = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(inside & F.col("path").startswith(rule.path), mine).otherwise(found)
    return found


def host_links(pages: DataFrame) -> DataFrame:
    """(a, b, weight): the share of a's links that go to b."""
    address = r"""(?i)\b(?:href|src)\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""
    # Links are taken out of each page where it is, and pages with equal links meet as counts.
    out = pages.select(
        F.col("host").alias("a"),
        F.explode(F.regexp_extract_all("html", F.lit(address), F.lit(1))).alias("b"),
    )
    out = out.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    out = out.select("a", lower_ascii(F.col("b")).alias("b"), "n")
    names = pages.select("host").distinct()
    parent = F.regexp_extract("host", r"^[^.]+\.([^.]+\..+)$", 1)
    up = names.select(F.col("host").alias("a"), parent.alias("b"), F.lit(1).cast("long").alias("n"))
    up = up.where(F.col("b") != "")
    down = up.select(F.col("b").alias("a"), F.col("a").alias("b"), "n")
    links = out.unionByName(up).unionByName(down)
    links = links.where((F.col("a") != F.col("b")) & (F.col("a") != "") & (F.col("b") != ""))
    return links.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _shares(links: DataFrame, kind: str) -> DataFrame:
    totals = links.groupBy("a").agg(F.sum("n").alias("total"))
    return links.join(totals, "a").select(
        F.lit(kind).alias("kind"), "a", "b", (F.col("n") / F.col("total")).alias("weight")
    )


def spread(
    seeds: DataFrame,
    links: DataFrame,
    scratch: Scratch,
    *,
    rounds: int,
    damping: float,
    write_each: int,
    settled: float,
) -> tuple[DataFrame, DataFrame]:
    """(kind, host, rank) after so many rounds, and settled: PageRank that restarts at the seeds
    (kind, host, rank), trust along the links and distrust against them."""
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"), "n")
    edges = scratch.put(_shares(links, "trust").unionByName(_shares(turned, "distrust")), "all_edges")
    # So many tasks as there are edges for: rounds are many, and a host graph is small.
    tasks = 1 + edges.count() // EDGES_OF_A_TASK
    edges = scratch.put(edges.coalesce(tasks), "edges")
    scratch.drop("all_edges")
    start = scratch.put(seeds.coalesce(tasks), "ranks_0")
    again = start.withColumn("rank", F.col("rank") * (1 - damping))
    ranks, early, before, k, written = start, start, start, 0, 0
    while True:
        k += 1
        moved = edges.join(ranks.withColumnRenamed("host", "a"), ["kind", "a"]).select(
            "kind", F.col("b").alias("host"), (F.col("weight") * F.col("rank") * damping).alias("rank")
        )
        ranks = moved.unionByName(again).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        ranks = ranks.coalesce(tasks)
        if k % write_each == 0 or k == rounds:
            ranks = scratch.put(ranks, f"ranks_{k}")
            early = ranks if k == rounds else early
            # The change is that of all rounds since the last ranks that were written.
            if k >= rounds and _is_settled(before, ranks, settled):
                return early, ranks
            if written not in (0, rounds):
                scratch.drop(f"ranks_{written}")
            before, written = ranks, k


def _is_settled(before: DataFrame, now: DataFrame, settled: float) -> bool:
    both = before.withColumn("rank", -F.col("rank")).unionByName(now)
    changed = both.groupBy("kind", "host").agg(F.abs(F.sum("rank")).alias("by"))
    return (changed.agg(F.max("by")).first()[0] or 0.0) <= settled


def _digits(rank: Column) -> Column:
    """To 12 digits, whatever its size, as the order of sums changes the last ones."""
    return F.format_string("%.11e", rank).cast("double")


def judged(
    pages: DataFrame,
    rules: list[Rule],
    *,
    rounds: int = 12,
    damping: float = 0.85,
    write_each: int = 4,
    ratio: float = 1.0,
    floor: float = 1e-9,
    settled: float = 1e-6,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust), a row for each row of pages."""
    scratch = Scratch(pages.sparkSession, "urls")
    rows = with_address(pages).withColumn("fit", rule_that_fits(rules))
    fitted = rows.where(F.col("fit").isNotNull())
    kinds = fitted.groupBy(
        F.when(F.col("fit.verdict") == "allow", "trust").otherwise("distrust").alias("kind"), "host"
    ).count()
    totals = kinds.groupBy("kind").agg(F.sum("count").alias("total"))
    seeds = kinds.select("kind", "host", F.col("count").cast("double").alias("rank"))
    early, last = spread(
        seeds,
        host_links(rows),
        scratch,
        rounds=rounds,
        damping=damping,
        write_each=write_each,
        settled=settled,
    )
    shares = early.join(totals, "kind").select(
        "kind", "host", _digits(F.col("rank") / F.col("total")).alias("share"), F.lit(0.0).alias("rank")
    )
    ranks = shares.unionByName(last.withColumn("share", F.lit(0.0)))
    of = lambda kind, what: F.sum(F.when(F.col("kind") == kind, F.col(what)).otherwise(0.0))
    by_host = ranks.groupBy("host").agg(
        of("trust", "share").alias("trust"),
        of("distrust", "share").alias("distrust"),
        _digits(of("trust", "rank")).alias("trusting"),
        _digits(of("distrust", "rank")).alias("distrusting"),
    )
    trust, distrust, trusting, distrusting = (
        F.coalesce(k, F.lit(0.0)) for k in ("trust", "distrust", "trusting", "distrusting")
    )
    blocked = (distrusting > floor) & (distrusting > ratio * trusting)
    by_method = F.when(blocked, "block").otherwise("allow")
    # One row per host: counted first, ranks reach each page through a join on its host.
    return (
        rows.select("page_id", "host", "path", "fit")
        .join(by_host, "host", "left")
        .select(
            "page_id",
            "host",
            "path",
            F.col("fit.rule").alias("rule"),
            F.coalesce("fit.verdict", by_method).alias("verdict"),
            trust.alias("trust"),
            distrust.alias("distrust"),
        )
    )
