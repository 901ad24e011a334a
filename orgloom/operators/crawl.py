"""Breadth-first reach over a link graph, level by level, and what a crawl may fetch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgloom.functions import outcomes, url
from orgloom.session import cut
from orgloom.sources.readers import allowed_by_robots


def fetch_results(urls: DataFrame, address: str, pages: DataFrame, rules: DataFrame, allowlist: list[str]) -> DataFrame:
    """``address, final_url, status, ok, html, fail_reason`` of each URL to be fetched, by a table of what was answered.

    ``pages``: ``url, final_url, status, content_type, html`` (one row for each
    URL). A URL that can't be public isn't fetched, nor one that its site's
    rules forbid, unless its host is on ``allowlist`` or below a host of it; one without an
    answer is a connection error. What was answered is then checked.
    """
    rows = allowed_by_robots(urls.select(address).distinct(), rules, address)
    rows = rows.withColumn("allowed", F.col("allowed") | url.host_matches(url.host(F.col(address)), allowlist))
    answer = pages.select(F.col("url").alias("__url"), "final_url", "status", "content_type", "html", F.lit(True).alias("__answered"))
    rows = rows.join(answer, F.col(address) == F.col("__url"), "left")
    reason = (
        F.when(~url.is_public_literal(F.col(address)), F.lit("blocked by url_guard: not a public address"))
        .when(~F.col("allowed"), F.lit("blocked by robots.txt"))
        .when(F.col("__answered").isNull(), F.lit("error: connection failed"))
        .otherwise(outcomes.fetch_problem(F.col("status"), F.col("content_type"), F.col("html")))
    )
    rows = rows.withColumn("fail_reason", reason)
    tried = ~F.coalesce(F.col("fail_reason").startswith("blocked"), F.lit(False))
    return rows.select(address, F.coalesce(F.when(tried, F.col("final_url")), F.col(address)).alias("final_url"), F.when(tried, F.col("status")).alias("status"), F.col("fail_reason").isNull().alias("ok"), F.when(F.col("fail_reason").isNull(), F.coalesce("html", F.lit(""))).otherwise("").alias("html"), "fail_reason")


def link_edges(fetched: DataFrame, address: str, blocked: list[str]) -> DataFrame:
    """``url, target, position``: links of pages that were fetched, resolved against where they were found in the end, without blocked hosts and files."""
    found = fetched.filter("ok").select(F.col(address).alias("url"), F.posexplode(url.links(F.col("final_url"), F.col("html"))).alias("position", "target"))
    return found.filter(url.crawlable(F.col("target")) & ~url.host_matches(url.host(F.col("target")), blocked)).select("url", "target", "position")


def reach(seeds: DataFrame, edges: DataFrame, pages: DataFrame, max_ok: int | None = 10, scoped: bool = False) -> DataFrame:
    """Pages in the order a first-in-first-out crawl visits them: ``seed, url, level, place, ok``.

    ``seeds``: ``seed, single`` (true for a shared platform, of which only the
    seed is read). ``edges``: ``url, target, position``, filtered by the
    caller to what may be crawled; with ``scoped``, links out of the seed's
    site are left out too. ``pages``: ``url, ok``; a URL without a row
    isn't ok. A page is visited once for each seed; a crawl ends when
    ``max_ok`` pages were ok (None: never). Within a level pages come by their parent's
    place, then by their position in it. Each level is a join of the frontier
    with the edges; visited pages are taken out by anti-joins with the levels'
    own tables, which are written once. It goes on until no page is left, however deep.
    """
    known = pages.select("url", "ok")
    frontier = seeds.select("seed", F.col("seed").alias("url"), F.lit(1).cast("long").alias("place"), "single").distinct()
    frontier = cut(frontier.join(known, "url", "left").select("seed", "url", "place", "single", F.coalesce("ok", F.lit(False)).alias("ok"), F.lit(0).alias("level")))
    level, levels, done = 0, [frontier], frontier.groupBy("seed").agg(F.count_if("ok").alias("n_ok"), F.max("place").alias("last"))
    while True:
        level += 1
        visited = reduce(DataFrame.unionByName, levels)
        grown = frontier.filter("ok and not single").join(edges.select("url", F.col("target"), "position"), "url").select("seed", F.col("target").alias("url"), F.struct("place", "position").alias("from"), "single")
        if scoped:
            grown = grown.filter(url.in_scope(F.col("seed"), F.col("url")))
        grown = grown.groupBy("seed", "url").agg(F.min("from").alias("from"), F.any_value("single").alias("single"))
        grown = grown.join(visited.select("seed", "url"), ["seed", "url"], "left_anti").join(done, "seed")
        grown = grown.join(known, "url", "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
        order = W.partitionBy("seed").orderBy("from", "url")
        grown = grown.withColumns({"nth": F.row_number().over(order), "ok_before": F.coalesce(F.sum(F.col("ok").cast("int")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))})
        if max_ok is not None:
            grown = grown.filter(F.col("n_ok") + F.col("ok_before") < max_ok)
        frontier = cut(grown.select("seed", "url", (F.col("last") + F.col("nth")).alias("place"), "single", "ok", F.lit(level).alias("level")))
        if frontier.isEmpty():
            return visited.select("seed", "url", "level", "place", "ok")
        levels.append(frontier)
        if len(levels) == 16:  # a plan of many levels is read as one table again
            levels = [cut(reduce(DataFrame.unionByName, levels))]
        done = cut(reduce(DataFrame.unionByName, levels).groupBy("seed").agg(F.count_if("ok").alias("n_ok"), F.max("place").alias("last")))
