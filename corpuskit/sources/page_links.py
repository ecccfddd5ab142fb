"""Links between web pages, read from their HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"'>]*)["']"""


def address(url: Column | str) -> Column:
    """A URL without query and fragment, which name the same page."""
    return F.regexp_replace(url, r"[?#].*$", "")


def resolved(url: Column | str, href: Column | str) -> Column:
    """The address that a link on the page at `url` leads to; NULL for links inside the page and to other than web pages.

    Absolute links stand for themselves, those with // take the page's scheme,
    those with / its site, others the folder that the page is in.
    """
    base = address(url)
    href = F.trim(F.replace(href, F.lit("&amp;"), F.lit("&")))
    scheme = F.regexp_extract(base, r"^([a-zA-Z]+:)//", 1)
    site = F.regexp_extract(base, r"^([a-zA-Z]+://[^/]*)", 1)
    folder = F.when(base == site, F.concat(site, F.lit("/"))).otherwise(F.regexp_replace(base, r"[^/]*$", ""))
    to = (
        F.when(href.rlike(r"^[?#]") | (href == ""), F.lit(None))
        .when(href.rlike(r"(?i)^https?://"), href)
        .when(href.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), F.lit(None))
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(site, href))
        .otherwise(F.concat(folder, href))
    )
    return address(to)


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """edges(src, dst): one for each link of each page, parallel ones too, whether or not the target is known.

    Pages without a URL or without HTML have none.
    """
    href = F.explode(F.regexp_extract_all(F.col(html), F.lit(_HREF), F.lit(1))).alias("_href")
    found = pages.select(F.col(url).alias("_url"), href)
    return found.select(address("_url").alias("src"), resolved("_url", "_href").alias("dst")).dropna()


def page_nodes(pages: DataFrame, edges: DataFrame, seen_from: int | None = None, url: str = "url") -> DataFrame:
    """nodes(node): the addresses of all pages, and of targets that at least `seen_from` pages link to.

    The latter are pages that are known to be there but have not been fetched,
    so they have no links of their own.
    """
    own = pages.select(address(url).alias("node")).filter("node IS NOT NULL").distinct()
    if seen_from is None:
        return own
    linked = edges.select("src", "dst").distinct().groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("n"))
    return own.union(linked.filter(F.col("n") >= seen_from).select("node")).distinct()
