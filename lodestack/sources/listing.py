"""A list of documents on HTML pages that were saved, of which some may have failed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import html_links


def listed_links(pages: DataFrame, number: str = "number", url: str = "url", html: str = "html", host: str = "", path: str = "", needs: str = "", limit: int | None = None) -> DataFrame:
    """(page, place, link): links to documents on all pages, each where it occurs first by page and place; `limit` of
    them at most, the first ones.

    Hosts, paths and a needed part are those of html_links(). Pages without content failed and are skipped, see
    failed_pages(); pages without a number come first. Links meet in one shuffle, combined before it, and a limit takes
    the first of each task before they meet. Repeated pages and empty tables are fine; extra columns are ignored.
    """
    p = pages.where(F.col(html).isNotNull()).select(F.col(number).alias("page"), F.posexplode(html_links(F.col(html), F.col(url), host, path, needs)).alias("place", "link"))
    first = p.groupBy("link").agg(F.min(F.struct("page", "place")).alias("f")).select("f.page", "f.place", "link")
    return first.orderBy("page", "place", "link").limit(limit) if limit is not None else first


def failed_pages(pages: DataFrame, number: str = "number", url: str = "url", html: str = "html") -> DataFrame:
    """(page, url) of pages that have no content, for another run."""
    return pages.where(F.col(html).isNull()).select(F.col(number).alias("page"), F.col(url).alias("url"))
