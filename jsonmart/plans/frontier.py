"""Crawl frontier: which ids the landed listings and credits ask for next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import as_bigint, blank_to_null
from ..functions.values import LISTING_PAGES, PEOPLE_CAP
from ..operators.conform import explode_array

col = F.col


def within_pages(listing: DataFrame, max_pages: int | None) -> DataFrame:
    """Pages up to ``max_pages`` and up to the page total that the listing states (at least 1)."""
    page, total = as_bigint(col("page")), as_bigint(blank_to_null(col("total_pages")))
    last = F.coalesce(F.nullif(total, F.lit(0)), F.lit(1))
    if max_pages is not None:
        last = F.least(last, F.lit(max_pages))
    return listing.where(F.coalesce(page, F.lit(0)) <= last)  # a page without a number counts as page 0


def _listed(listing: DataFrame, max_pages: int | None) -> DataFrame:
    items = explode_array(within_pages(listing, max_pages), "results", ["id"]).where(col("id").isNotNull())
    return items.select(as_bigint(col("id")).alias("movie_id"))


def listing_ids(listing: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Distinct ids of one listing, ascending."""
    return _listed(listing, max_pages).distinct().orderBy("movie_id")


def movie_ids(popular: DataFrame, top_rated: DataFrame, max_pages: int | None = LISTING_PAGES) -> DataFrame:
    """Ids of both listings, ascending."""
    both = _listed(popular, max_pages).union(_listed(top_rated, max_pages))
    return both.distinct().orderBy("movie_id")


def people_ids(credits: DataFrame) -> DataFrame:
    """Distinct people over cast and crew, ascending."""
    items = explode_array(credits, ["cast", "crew"], ["id"]).where(col("id").isNotNull())
    return items.select(as_bigint(col("id")).alias("person_id")).distinct().orderBy("person_id")


def cap(ids: DataFrame, n: int = PEOPLE_CAP) -> DataFrame:
    """The n smallest ids."""
    return ids.orderBy(ids.columns[0]).limit(n)
