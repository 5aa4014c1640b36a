"""Discovery of files and releases in landed catalogue pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.functions.releases import (
    is_release_url, release_from_url, release_key, release_month, release_page,
)
from gridtide.functions.text import clean_text, collapse, strip, table_no
from gridtide.functions.urls import (
    DOWNLOAD_HREF, absolute_url, context_score, file_title, file_type, indexed_filename,
    looks_like_cube, table_no_from_filename, table_title, title_score, url_filename, without_query,
)
from gridtide.operators.catalogue import distinct_releases
from gridtide.schemas import FILE_INDEX, RELEASES
from gridtide.sources.pages import page_outlines
from gridtide.staging import settle, stage

SEED = [
    "cat_no", "title", "description", "page_url", "file_title", "url", "filename",
    "table_no", "is_timeseries", "is_cube",
]


def link_contexts(outlines: DataFrame, base_url: str) -> DataFrame:
    """Best text around each download link of a page.

    Candidates come in selector order, then document order. A text replaces the one kept
    so far when it scores higher; a text shared by several downloads only fills a gap.
    """
    contexts = outlines.select("page_id", F.inline("contexts"))
    contexts = settle(contexts, text=collapse(F.col("text")))
    urls = F.array_distinct(
        F.transform(
            F.filter("hrefs", lambda href: href.rlike(DOWNLOAD_HREF)),
            lambda href: without_query(absolute_url(href, base_url)),
        )
    )
    # scored once, however many links a text has
    candidates = contexts.where(F.col("text") != "").select(
        "page_id", "selector", "ord", "text", urls.alias("urls"),
        context_score(F.col("text")).alias("score"),
    )
    single = candidates.select(
        "page_id", F.explode("urls").alias("url"), "selector", "ord", "text",
        (F.size("urls") > 1).alias("shared"), "score",
    )
    # All candidates of one URL on one page: a handful of enclosing elements.
    ordered = F.array_sort(F.collect_list(F.struct("selector", "ord", "shared", "score", "text")))
    start = F.named_struct(F.lit("text"), F.lit(""), F.lit("score"), F.lit(0))

    def fold(kept: Column, new: Column) -> Column:
        taken = F.named_struct(F.lit("text"), new["text"], F.lit("score"), new["score"])
        blocked = new["shared"] & (kept["text"] != "")
        return F.when(~blocked & (new["score"] > kept["score"]), taken).otherwise(kept)

    return (
        single.groupBy("page_id", "url")
        .agg(F.aggregate(ordered, start, fold)["text"].alias("context"))
    )


def page_downloads(outlines: DataFrame, base_url: str) -> DataFrame:
    """Download links of each page: page_id, ord, url, label, context."""
    links = outlines.select("page_id", F.inline("links")).where(F.col("href").rlike(DOWNLOAD_HREF))
    placed = links.select(
        "page_id", "ord",
        without_query(absolute_url(F.col("href"), base_url)).alias("url"),
        collapse(F.col("label")).alias("label"),
    )
    found = placed.join(link_contexts(outlines, base_url), ["page_id", "url"], "left")
    return found.withColumn("context", F.coalesce("context", F.lit("")))


def file_rows(downloads: DataFrame) -> DataFrame:
    """Index rows of download links; the best titled row of a URL counts, later on ties.

    ``downloads`` has ``page_key, ord, url, label, context`` and the catalogue columns
    ``cat_no, title, description, page_url, seed_url``.
    """
    url, title, name = F.col("url"), F.col("file_title"), F.col("url_name")
    rows = downloads.withColumns(
        {"file_title": file_title(F.col("label"), F.col("context"), url), "url_name": url_filename(url)}
    )
    rows = rows.withColumn("table_title", table_title(title, F.col("context")))
    number = F.coalesce(
        table_no(title), table_no(F.col("context")), table_no(url),
        table_no_from_filename(F.col("cat_no"), url, name), F.lit(""),
    )
    release = F.coalesce(
        release_from_url(url), release_from_url(F.col("page_url")),
        release_from_url(F.col("seed_url")), F.lit(""),
    )
    cube = looks_like_cube(title, url)
    rows = rows.withColumns(
        {
            "release_date": release,
            "filename": indexed_filename(F.col("cat_no"), url, title, name),
            "file_type": file_type(url, title, name),
            "table_no": number,
            "is_timeseries": ~cube,
            "is_cube": cube,
            "score": title_score(title) + title_score(F.col("table_title")),
        }
    )
    best = F.max_by(F.struct(*FILE_INDEX.names), F.struct("score", "ord")).alias("best")
    return rows.groupBy("cat_no", "page_key", "url").agg(best).select("page_key", "best.*")


def seed_rows(seeds: DataFrame) -> DataFrame:
    """Index rows made from the seeds themselves."""
    return seeds.select(
        "cat_no", "title", "description", "page_url",
        F.coalesce(release_from_url(F.col("url")), F.lit("")).alias("release_date"),
        "file_title", "url", "filename", F.lit("xlsx").alias("file_type"), "table_no",
        F.col("file_title").alias("table_title"), "is_timeseries", "is_cube",
    )


def release_links(landing: DataFrame, base_url: str) -> DataFrame:
    """Links of a landing page to its release pages: below the page and named like it.

    ``landing`` has ``cat_no, title, page_url`` and a ``links`` array.
    """
    links = landing.select("cat_no", "title", "page_url", F.inline("links"))
    links = settle(links, url=absolute_url(F.col("href"), base_url))
    path = F.replace(F.col("page_url"), F.lit(base_url), F.lit(""))
    below = F.col("url").startswith(F.concat(F.col("page_url"), F.lit("/"))) | F.col(
        "href"
    ).startswith(F.concat(path, F.lit("/")))
    name = F.lower(F.substring_index("title", ",", 1))
    named = F.lower(strip(F.col("label"))).contains(name)
    found = links.where(below & named).select("cat_no", "url", "ord")
    return found.groupBy("cat_no", "url").agg(F.min("ord").alias("ord"))


def archive_links(landing: DataFrame, base_url: str) -> DataFrame:
    """Links of a landing page to lists of earlier releases."""
    links = landing.select("cat_no", "page_url", F.inline("links"))
    links = settle(links, url=without_query(absolute_url(F.col("href"), base_url)))
    links = links.where(F.col("url").startswith(F.col("page_url")))
    links = settle(links, words=F.lower(F.concat_ws(" ", "url", collapse(F.col("label")))))
    words = F.col("words")
    archive = words.contains("archive") | words.contains("previous") | words.contains(
        "past releases"
    )
    return links.where(archive).select("cat_no", "url").distinct()


def discover_files(
    pages: DataFrame, seeds: DataFrame, base_url: str, outlines: DataFrame | None = None
) -> DataFrame:
    """File index of all seed catalogues from landed pages (``page_id, url, html``).

    A catalogue takes the files of its landing page; without any, those of the first
    release page that has some; without that, its seed row. ``outlines`` are those of the pages
    with contexts, where they are there already.
    """
    # Each page is parsed once; its outline is small and read several times.
    outlines = stage(page_outlines(pages), "outlines") if outlines is None else outlines
    page_keys = pages.select(F.col("page_id").cast("bigint"), F.col("url").alias("page"))
    downloads = page_downloads(outlines, base_url)
    described = outlines.select("page_id", "h1", "description", "links").join(page_keys, "page_id")
    landing = described.join(
        seeds.withColumnsRenamed({"url": "seed_url", "description": "seed_description"}),
        F.col("page") == F.col("page_url"),
    ).select(
        "page_id", "cat_no", "page_url", "seed_url", "links", "title",
        F.coalesce(clean_text(F.col("h1")), "title").alias("page_title"),
        F.coalesce(clean_text(F.col("description")), "seed_description").alias("description"),
    )
    # read three times below
    landing = stage(landing, "landing-pages")
    facts = landing.select(
        "cat_no", "description", "seed_url", F.col("page_title").alias("title")
    )
    own = landing.select(
        "page_id", "cat_no", "page_url", F.lit(0).alias("page_key")
    )
    linked = (
        release_links(landing, base_url)
        .withColumnsRenamed({"url": "page_url", "ord": "page_key"})
        .join(page_keys.withColumnRenamed("page", "page_url"), "page_url")
        .select("page_id", "cat_no", "page_url", "page_key")
    )
    # page_key 0 is the landing page, then the release pages in link order.
    visits = own.unionByName(linked).join(facts, "cat_no")
    rows = stage(file_rows(downloads.join(visits, "page_id")), "page-files")
    first = rows.groupBy("cat_no").agg(F.min("page_key").alias("page_key"))
    found = rows.join(first, ["cat_no", "page_key"]).drop("page_key").select(*FILE_INDEX.names)
    missing = seeds.join(found.select("cat_no").distinct(), "cat_no", "left_anti")
    return found.unionByName(seed_rows(missing).select(*FILE_INDEX.names))


def release_rows(links: DataFrame, seeds: DataFrame, base_url: str) -> DataFrame:
    """Releases named by links: a dated page below a seed's catalogue page.

    ``links`` has ``ord, href, label`` and either the ``cat_no`` it was found for or only
    a URL that decides it.
    """
    known = seeds.select("cat_no", F.col("title").alias("seed_title"), "page_url")
    url = without_query(absolute_url(F.col("href"), base_url))
    placed = settle(links, release_url=url, label=collapse(F.col("label")))
    if "cat_no" in links.columns:
        joined = placed.join(known, "cat_no")
    else:
        # The catalogue page is the release URL up to one of its slashes.
        placed = placed.withColumn("page_url", F.explode(url_prefixes(F.col("release_url"))))
        joined = placed.join(known, "page_url")
    dated = settle(
        joined.where(is_release_url(F.col("release_url"), F.col("page_url"))),
        release_date=F.coalesce(
            release_month(F.col("label")),
            release_month(release_from_url(F.concat(F.col("release_url"), F.lit("/")))),
        ),
    )
    title = F.when(F.col("label") != "", F.col("label")).otherwise(F.col("seed_title"))
    rows = dated.where(F.col("release_date").isNotNull()).withColumn("title", title)
    return distinct_releases(rows).select(*RELEASES.names)


def url_prefixes(url: Column) -> Column:
    """All proper prefixes of a URL that end before a slash."""
    parts = F.split(url, "/")
    counts = F.sequence(F.lit(1), F.size(parts) - 1)
    return F.transform(counts, lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def seed_releases(seeds: DataFrame) -> DataFrame:
    """Release rows made from the seeds; undatable ones get the first day of year 1."""
    date = F.coalesce(
        release_month(release_from_url(F.col("url"))), F.lit("0001-01-01").cast("date")
    )
    return seeds.select(
        "cat_no", "title", date.alias("release_date"), release_page(F.col("url")).alias("release_url")
    )


def discover_releases(
    pages: DataFrame, seeds: DataFrame, base_url: str, outlines: DataFrame | None = None
) -> DataFrame:
    """Releases of all seed catalogues from landing and archive pages.

    A catalogue for which no page names a release keeps its seed release. Order is left to the
    caller. ``outlines`` are those of the pages, where they are there already.
    """
    if outlines is None:
        outlines = stage(page_outlines(pages, contexts=False).drop("contexts"), "outlines")
    page_keys = pages.select(F.col("page_id").cast("bigint"), F.col("url").alias("page"))
    keyed = outlines.select("page_id", "links").join(page_keys, "page_id")
    landing = keyed.join(seeds, F.col("page") == F.col("page_url")).select(
        "cat_no", "title", "page_url", "links"
    )
    archives = archive_links(landing, base_url).withColumnRenamed("url", "page")
    archived = keyed.join(archives, "page").select("cat_no", "links")
    links = reduce(
        DataFrame.unionByName,
        [
            landing.select("cat_no", F.lit(0).alias("level"), F.inline("links")),
            archived.select("cat_no", F.lit(1).alias("level"), F.inline("links")),
        ],
    )
    ordered = links.withColumn("ord", F.struct("level", "ord"))
    found = stage(release_rows(ordered, seeds, base_url), "page-releases")
    missing = seeds.join(found.select("cat_no").distinct(), "cat_no", "left_anti")
    return found.unionByName(seed_releases(missing)).dropDuplicates(
        ["cat_no", "release_date", "release_url"]
    )


def files_of_release(
    pages: DataFrame, releases: DataFrame, seeds: DataFrame, base_url: str
) -> DataFrame:
    """Files on the pages of the given releases that belong to the release month."""
    page_keys = pages.select(F.col("page_id").cast("bigint"), F.col("url").alias("page_url"))
    facts = seeds.select(
        "cat_no", "description", F.col("title").alias("seed_title"), F.col("url").alias("seed_url")
    )
    visits = (
        releases.withColumnRenamed("release_url", "page_url")
        .join(page_keys, "page_url")
        .join(facts, "cat_no")
        .select(
            "page_id", "cat_no", "description", "seed_url", "page_url",
            F.coalesce(clean_text(F.col("title")), "seed_title").alias("title"),
            release_key(F.col("release_date")).alias("page_key"),
        )
    )
    outlines = stage(page_outlines(pages), "outlines")
    rows = file_rows(page_downloads(outlines, base_url).join(visits, "page_id"))
    return rows.where(F.col("release_date") == F.col("page_key")).select(*FILE_INDEX.names)
