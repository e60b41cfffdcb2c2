"""A catalog's search pages as rows, what of them is worth a look, and a cursor that goes round."""

import html as entities
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A result of a search page: an anchor of that class, up to its end.
_RESULT = r'(?s)(<a\b[^>]*class="[^"]*search_result_row[^"]*"[^>]*>.*?</a>)'


def attribute(tag: Column, name: str) -> Column:
    """Of an element's text; null if it has none."""
    return F.nullif(F.regexp_extract(tag, rf'\b{name}="([^"]*)"', 1), F.lit(""))


def inner_text(tag: Column, of_class: str) -> Column:
    """The text inside the first element of a class, without tags, white space joined; null if there is none."""
    inside = F.regexp_extract(tag, rf'(?s)<(?:span|div)\b[^>]*class="[^"]*\b{of_class}\b[^"]*"[^>]*>(.*?)</(?:span|div)>', 1)
    bare = F.trim(F.regexp_replace(F.regexp_replace(inside, r"<[^>]*>", " "), r"\s+", " "))
    found = tag.rlike(rf'class="[^"]*\b{of_class}\b')
    for written, meant in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(written), F.lit(meant))
    return F.when(found, bare)


def search_results(pages: DataFrame, html: str = "html", start: str = "start") -> DataFrame:
    """A row a result that has an id: appid, title, search_release_text, search_review_summary, catalog_start."""
    rows = pages.select(F.col(start).alias("catalog_start"), F.explode(F.regexp_extract_all(html, F.lit(_RESULT), F.lit(1))).alias("a"))
    appid = F.expr("try_cast(regexp_extract(a, 'data-ds-appid=\"([^\"]*)\"', 1) AS int)")
    review = F.regexp_extract("a", r'(?s)(<span\b[^>]*class="[^"]*search_review_summary[^"]*"[^>]*>)', 1)
    found = rows.select(appid.alias("appid"), inner_text(F.col("a"), "title").alias("title"), inner_text(F.col("a"), "search_released").alias("search_release_text"), attribute(review, "data-tooltip-html").alias("search_review_summary"), "catalog_start")
    return found.where("appid IS NOT NULL")


def links(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """A row a link of a page, in order: place, target, label."""
    found = F.regexp_extract_all(html, F.lit(r'(?s)(<a\b[^>]*href="[^"]*"[^>]*>.*?</a>)'), F.lit(1))
    rows = pages.select(key, F.posexplode(found).alias("place", "a"))
    return rows.select(key, "place", attribute(F.col("a"), "href").alias("target"), F.trim(F.regexp_replace("a", r"<[^>]*>", "")).alias("label"))


def candidates(results: DataFrame, known: DataFrame) -> DataFrame:
    """Results not known yet, the first of a repeated id."""
    fresh = results.join(known.select("appid"), "appid", "left_anti")
    rest = [c for c in results.columns if c not in ("appid", "catalog_start")]
    return fresh.groupBy("appid").agg(F.min(F.struct("catalog_start", *rest)).alias("r")).select("appid", "r.*")


def next_start(start: int, found: int, page_size: int, total: int) -> int:
    """Where the next run begins: after what was found, and from the front again at the end."""
    after = start + (found or page_size)
    return 0 if after >= total else after


def eligibility(landed: DataFrame) -> DataFrame:
    """landed games with why they aren't eligible, the first reason; null for eligible ones."""
    why = F.when(~F.coalesce("success", F.lit(False)), F.lit("METADATA_FAILED")).when(~F.col("data.type").eqNullSafe("game"), F.lit("NOT_A_GAME")).when(F.col("data.release_date.coming_soon"), F.lit("COMING_SOON"))
    return landed.withColumn("excluded", why)


def eligible(landed: DataFrame) -> DataFrame:
    return eligibility(landed).where("excluded IS NULL").drop("excluded")


@dataclass(frozen=True)
class Refresh:
    """What a run over some pages of the catalog found, and where the next begins."""

    start: int
    pages: int
    fresh: DataFrame


def refresh(fetch: Callable[[int], tuple[DataFrame, int, int]], known: DataFrame, start: int, page_size: int, most_pages: int) -> Refresh:
    """fetch: start -> (page with html and start, results on it, results in all). Goes round at the end, and stops where it began."""
    first, at, n, found = start, start, 0, None
    while n < most_pages:
        page, count, total = fetch(at)
        n += 1
        found = search_results(page) if found is None else found.unionByName(search_results(page))
        at = next_start(at, count, page_size, total)
        if at == first:
            break
    if found is None:
        raise ValueError("a refresh reads at least one page")
    return Refresh(at, n, candidates(found, known))


def unescaped(text: str) -> str:
    return entities.unescape(text)
