"""Links of stored web pages: every ``a href``, resolution against the page, latest folder.

Pages are rows (``page_id, url, html``); extraction is a JVM regex over the
HTML column followed by ``posexplode``, so it splits like any scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabelion.functions import resolve_link

# An anchor tag up to its first href attribute: any case, other attributes (quoted or not) before it, and the value
# double-quoted, single-quoted or bare. ``data-href`` is another attribute.
ANCHOR = (
    r"""(?is)<a(?:\s+(?!href[\s=])[^\s=>"'/]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*+"""
    r"""\s+href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
)
# Entities that occur in addresses (fixed values); the ampersand comes last.
ENTITIES = {"&quot;": '"', "&#34;": '"', "&apos;": "'", "&#39;": "'", "&lt;": "<", "&gt;": ">", "&#38;": "&", "&amp;": "&"}
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)"


def links(pages: DataFrame) -> DataFrame:
    """One row per anchor with an href: page_id, url, link_pos (0-based), href (entities decoded)."""
    tags = F.regexp_extract_all("html", F.lit(ANCHOR), 0)
    found = pages.select("page_id", "url", F.posexplode(tags).alias("link_pos", "_tag"))
    value = F.lit("")
    for group in (3, 2, 1):
        part = F.regexp_extract("_tag", ANCHOR, group)
        value = F.when(part != "", part).otherwise(value)
    for entity, char in ENTITIES.items():
        value = F.replace(value, F.lit(entity), F.lit(char))
    return found.select("page_id", "url", "link_pos", value.alias("href"))


def resolved_links(pages: DataFrame, suffix: str | None = None) -> DataFrame:
    """Links ending in ``suffix`` (all when None), absolute kept, relative appended to the page address."""
    ls = links(pages)
    if suffix is not None:
        ls = ls.filter(F.col("href").endswith(suffix))
    return ls.select("page_id", "link_pos", "href", resolve_link("href", "url").alias("resolved_url"))


def latest_link(pages: DataFrame, prefix: str) -> DataFrame:
    """Per site, the greatest link starting with ``prefix`` (the latest dated folder)."""
    ls = links(pages).filter(F.col("href").startswith(prefix))
    return ls.groupBy(F.regexp_extract("url", HOST, 1).alias("host")).agg(
        F.max("href").alias("latest_href"), F.count(F.lit(1)).alias("n_links")
    )


def latest_folder_archives(index: DataFrame, folders: DataFrame, prefix: str = "20", suffix: str = ".zip") -> DataFrame:
    """Per site, the archives of its latest dated folder: host, folder_url, href, resolved_url.

    ``index`` are the sites' top pages and ``folders`` the pages of the dated
    folders (page_id, url, html), each under its index page's address. Of a
    site the greatest link starting with ``prefix`` is the latest folder; the
    links of that folder's page that end in ``suffix`` are resolved against it.
    """
    dated = links(index).filter(F.col("href").startswith(prefix))
    host = F.regexp_extract("url", HOST, 1).alias("host")
    latest = dated.groupBy(host).agg(F.max_by(resolve_link("href", "url"), "href").alias("folder_url"))
    found = links(folders).filter(F.col("href").endswith(suffix))
    return latest.join(found, F.col("folder_url") == F.col("url")).select(
        "host", "folder_url", "href", resolve_link("href", "folder_url").alias("resolved_url")
    )
