"""The data steps of a crawl, on records already fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factspark.functions.markup import embedded_json, page_heading
from factspark.functions.paths import (
    resolve_url,
    safe_file_name,
    search_term,
    search_url,
    slug_file,
    slug_title,
    wiki_url,
)
from factspark.functions.strings import is_blank, without_prefix
from factspark.schemas import LISTING_DATA

# Namespace numbers of a wiki.
TALK, CATEGORY_TALK = 1, 15


def listing_items(listings: DataFrame, fallback: bool = True) -> DataFrame:
    """The non-empty links in the data a listing page embeds, as ``url, link``.

    With ``fallback`` an empty ``result`` list gives way to ``items``.
    """
    data = F.from_json(embedded_json(F.col("html"), "__NEXT_DATA__"), LISTING_DATA)
    result = F.col("d.props.pageProps.data.result")
    items = F.col("d.props.pageProps.data.items")
    links = F.when(F.size(result) > 0, result).otherwise(items) if fallback else result
    return (
        listings.select("url", data.alias("d"))
        .select("url", F.explode(links).alias("item"))
        .select("url", F.col("item.url").alias("link"))
        .filter(F.col("link") != "")
    )


def listing_links(listings: DataFrame, fallback: bool = True) -> DataFrame:
    """The pages a listing leads to, as ``url, link, target_url``."""
    return listing_items(listings, fallback).withColumn(
        "target_url", resolve_url(F.col("url"), F.col("link"))
    )


def page_title(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``title``: the first heading, else the words of the URL."""
    heading = page_heading(F.col(html))
    return pages.withColumn("title", F.coalesce(heading, slug_title(F.col("url"))))


def page_records(pages: DataFrame, folder: str, fetched_at: str) -> DataFrame:
    """Fetched pages (``url, html`` and a time) to stored records and their file."""
    return page_title(pages).select(
        "title",
        F.col("html").alias("content"),
        F.date_format(fetched_at, "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        "url",
        slug_file(F.col("url"), folder).alias("target_path"),
    )


def search_requests(lines: DataFrame, base: str) -> DataFrame:
    """Dictionary lines to one search per name: ``name, url, target_path``."""
    names = F.split("line", ", ")
    term = search_term(F.col("name"))
    return (
        lines.select(F.element_at(names, 1).alias("canonical"), F.explode(names).alias("name"))
        .filter(~is_blank(F.col("name")))
        .select(
            "canonical",
            "name",
            search_url(term).alias("url"),
            F.concat(F.lit(base + "/"), "canonical", F.lit("/"), term, F.lit(".json")).alias(
                "target_path"
            ),
        )
    )


def talk_articles(members: DataFrame, folder: str) -> DataFrame:
    """Discussion pages of a category to the articles they discuss; empty ones drop out."""
    title = without_prefix(F.col("title"), "Talk:")
    return (
        members.filter((F.col("ns") == TALK) & (F.col("content") != ""))
        .select(title.alias("title"), "content")
        .select(
            "title",
            "content",
            wiki_url(F.col("title")).alias("url"),
            F.concat(F.lit(folder + "/"), safe_file_name(F.col("title")), F.lit(".json")).alias(
                "target_path"
            ),
        )
    )
