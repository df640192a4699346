"""Paginated listings, walked to a fixed point over captured pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.shared import written


def crawl(listings: DataFrame, site: str = "site", page: str = "page", items: str = "items", last: str = "last_page", pager: str = "first", max_pages: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(visited pages, distinct items by site) of listings (site, page from 1, items: array of links, last_page said by the pager).

    Each round fetches the frontier: all pages up to a site's last known page that were not met yet. The last page is that
    of the first page's pager, or with pager="every" the greatest said by any page met so far; null and less count as the
    page itself. A site ends at its first page past the first without items, or that was not captured; pages behind it do
    not count, nor what they say. Rounds and site states are written to the shared folder, so no round runs twice. A site
    that lacks its first page has none. Null links are left out; a page captured twice counts with its items together.
    """
    spark = listings.sparkSession
    known = listings.filter(F.col(site).isNotNull() & (F.col(page) >= 1)).select(F.col(site).alias("site"), F.col(page).cast("long").alias("page"), F.coalesce(F.col(items), F.array().cast("array<string>")).alias("items"), F.col(last).cast("long").alias("last"))
    if max_pages:
        known = known.filter(F.col("page") <= max_pages)
    known = written(known.groupBy("site", "page").agg(F.flatten(F.collect_list("items")).alias("items"), F.max("last").alias("last")), "listings")
    sites = written(known.filter("page = 1").select("site", F.lit(0).cast("long").alias("done"), F.lit(1).cast("long").alias("last"), F.lit(None).cast("long").alias("empty")), "sites")
    rounds = []
    while not sites.filter("last > done AND empty IS NULL").isEmpty():
        frontier = sites.filter("last > done AND empty IS NULL").select("site", F.explode(F.sequence(F.col("done") + 1, F.col("last"))).alias("page"))
        got = written(frontier.join(known, ["site", "page"], "left"), "fetched")
        ends = got.filter("page > 1 AND (items IS NULL OR size(items) = 0)").groupBy("site").agg(F.min("page").alias("end"))
        met = written(got.join(ends, "site", "left").filter("items IS NOT NULL AND (end IS NULL OR page < end)").select("site", "page", "items", "last"), "met")
        rounds.append(met)
        said = met if pager == "every" else met.filter("page = 1")
        said = said.groupBy("site").agg(F.max("last").alias("said"))
        sites = written(
            sites.join(said, "site", "left").join(ends, "site", "left")
            .select("site", F.greatest("last", "done").alias("done"), F.greatest("last", "said").alias("last"), F.coalesce("empty", "end").alias("empty")), "sites",
        )
    visited = rounds[0] if rounds else known.limit(0)
    for r in rounds[1:]:
        visited = visited.unionByName(r)
    links = visited.select("site", F.explode("items").alias("url")).filter("url IS NOT NULL").distinct()
    return visited.select(F.col("site").alias(site), F.col("page").alias(page)), links.select(F.col("site").alias(site), "url")
