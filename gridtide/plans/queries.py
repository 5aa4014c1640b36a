"""The registered queries: each runs one or more operators over whole tables."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window as W

from gridtide.functions.numbers import text_number
from gridtide.functions.periods import period_start, text_period
from gridtide.functions.releases import (
    release_from_url, release_key, release_month, release_page,
)
from gridtide.functions.text import (
    clean_text, collapse, looks_like_series_id, metadata_key, normalise_frequency,
    normalise_name, table_no,
)
from gridtide.functions.urls import (
    absolute_url, extension, file_type, is_generic_label, table_no_from_filename, title_score,
    url_filename, without_query,
)
from gridtide.operators import catalogue, cubes, discovery, rebuild, requests, sdmx, series, timeseries
from gridtide.operators.context import looks_like_table_title, sheet_context
from gridtide.operators.sheets import infer_frequency
from gridtide.operators.tables import match_tables, select_sheets
from gridtide.plans import books, inputs
from gridtide.plans.inputs import BASE_URL, month_of, stored_cells, table, wide_table
from gridtide.schemas import FILE_INDEX
from gridtide.sources import inventory, pages as page_source
from gridtide.sources.inventory import source_inventory
from gridtide.sources.wide import cells_from_wide
from gridtide.sources.workbooks import parse_workbooks, sheets_of
from gridtide.staging import spread, stage, staging_root
from gridtide.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
TIDY = ["source_file", "sheet", "sheet_no", "date", "series_id", "value", "unit", "frequency", "series"]


def _text(value: str) -> Column:
    return F.lit(value)


# ---------------------------------------------------------------- time series sheets


def tidy_time_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = stored_cells(inputs.supplier_month_cells(spark, sf_dir))
    return timeseries.tidy(cells, layout="down").select(*TIDY, "table_no")


def tidy_time_across(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = stored_cells(inputs.priority_month_cells(spark, sf_dir))
    return timeseries.tidy(cells, layout="across").select(
        *TIDY, "release_date", "table_no", "table_title"
    )


def tidy_fallback_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = stored_cells(
        inputs.supplier_month_cells(spark, sf_dir) + inputs.priority_month_cells(spark, sf_dir)
    )
    return timeseries.tidy(cells).select("source_file", "sheet_no", "date", "series_id", "value")


def tidy_no_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = stored_cells(inputs.supplier_month_cells(spark, sf_dir))
    return timeseries.tidy(cells, metadata=False).select(*TIDY)


def series_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = stored_cells(
        inputs.supplier_month_cells(spark, sf_dir)
        + inputs.priority_month_cells(spark, sf_dir)
        + inputs.supplier_label_cells(spark, sf_dir)
    )
    return timeseries.series_metadata(cells).select(
        "source_file", "sheet", "series_id", "unit", "frequency", "series", "source_workbook"
    )


def metadata_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = stored_cells(inputs.supplier_label_cells(spark, sf_dir))
    return timeseries.label_only_metadata(cells).select(
        "sheet", "series_id", "unit", "frequency", "series"
    )


def context_of_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = stored_cells(inputs.customer_head_cells(spark, sf_dir))
    return sheet_context(cells).select(
        "source_file", "cat_no", "release_date", "table", "table_no", "table_title"
    )


def table_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, nation = table(spark, sf_dir, "part"), table(spark, sf_dir, "nation")
    sheets = part.select(
        F.concat_ws(" ", F.lit("Table"), "p_size", "p_type", "p_name").alias("sheet")
    ).distinct()
    requests = (
        part.select(F.col("p_size").cast("string").alias("request"))
        .unionByName(part.select(F.lower("p_type").alias("request")))
        .unionByName(part.select(F.col("p_name").alias("request")))
        .unionByName(part.select(F.concat_ws(" ", F.lit("TABLE"), "p_size").alias("request")))
        .unionByName(nation.select(F.col("n_name").alias("request")))
    )
    return match_tables(sheets, requests)


def raw_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("Customer name"),
        F.col("c_mktsegment").alias("Customer name?"), F.col("c_nationkey").alias("Nation no."),
    )
    cells = cells_from_wide(
        customer, "customers", 1, "Customers", F.col("c_custkey") + 1
    )
    records = cubes.raw_records(cells)
    names = ["c_custkey", "Customer_name", "Customer_name_2", "Nation_no"]
    return cubes.to_wide(records, names).select("row_no", *names)


# ---------------------------------------------------------------- scalar rules


def period_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = wide_table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    year, quarter = F.date_format(day, "yyyy"), F.concat(F.lit("Q"), F.quarter(day))
    styles = [
        year, F.date_format(day, "yyyy-MM"), F.concat_ws("-", year, quarter),
        F.concat_ws(" ", quarter, year), F.date_format(day, "MMM-yy"),
        F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "dd/MM/yyyy"),
        F.date_format(day, "MMMM yyyy"), F.col("o_orderpriority"),
    ]
    label = F.element_at(F.array(*styles), (F.col("o_orderkey") % len(styles) + 1).cast("int"))
    parsed = orders.select("o_orderkey", label.alias("label")).withColumn(
        "period", text_period("label")
    )
    date = F.col("period.date")
    frequency = F.when(date.isNotNull(), F.col("period.frequency"))
    return parsed.select(
        "o_orderkey", "label", date.alias("date"), frequency.alias("frequency"),
        period_start(date, _text("quarterly")).alias("quarter_start"),
        period_start(date, _text("annual")).alias("year_start"),
    )


def number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = wide_table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    plain = price.cast("string")
    styles = [
        F.format_number(price, 2), plain, F.concat(F.lit(" -"), plain, F.lit(" ")),
        F.lit(".."), F.lit("NP"), F.concat(plain, F.lit("d")), F.concat(F.lit("+"), plain, F.lit("e1")),
        F.lit("Infinity"),
    ]
    style = (F.col("l_orderkey") % len(styles)).cast("int")
    return line.select(
        "l_orderkey", "l_linenumber",
        text_number(F.element_at(F.array(*styles), style + 1)).alias("value"),
    )


def frequency_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    dates = orders.select(
        "o_custkey", F.to_date("o_orderdate").alias("period_date"),
        F.lit("unknown").alias("period_frequency"),
    )
    return infer_frequency(dates, ["o_custkey"]).withColumnRenamed("inferred", "frequency")


def frequency_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    words = [
        "Monthly", " Quarterly", "ANNUAL", "Yearly", "weekly", "Fortnightly", "Biannual",
        "Semiannually", "Half-yearly", "Daily", "day", "Mystery",
    ]
    label = F.element_at(
        F.array(*[F.lit(w) for w in words]), (F.col("o_orderkey") % len(words) + 1).cast("int")
    )
    label = F.when(F.col("o_totalprice") < 5000, "").otherwise(label)
    return orders.select("o_orderkey", normalise_frequency(label).alias("frequency"))


def key_and_name_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, nation = table(spark, sf_dir, "part"), table(spark, sf_dir, "nation")
    label = F.concat(F.col("p_name"), F.lit("  ("), F.col("p_brand"), F.lit(")"))
    texts = part.select("p_partkey", label.alias("label")).unionByName(
        nation.select((-F.col("n_nationkey") - 1).cast("bigint").alias("p_partkey"),
                      F.concat(F.lit(" "), F.col("n_name"), F.lit("%")).alias("label"))
    )
    return texts.select(
        "p_partkey", metadata_key(F.col("label")).alias("label_key"),
        normalise_name(F.col("label")).alias("name"),
    )


def layout_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    title = F.concat_ws(" ", F.lit("Tables"), F.concat("p_size", F.lit("b")), F.lit("to"), "p_name")
    texts = [
        part.select(F.col("p_partkey").alias("id"), F.lit("name").alias("source"),
                    F.col("p_name").alias("text")),
        part.select(F.col("p_partkey").alias("id"), F.lit("type").alias("source"),
                    F.concat(F.col("p_type"), F.col("p_size")).alias("text")),
        part.select(F.col("p_partkey").alias("id"), F.lit("title").alias("source"),
                    title.alias("text")),
        part.select(F.col("p_partkey").alias("id"), F.lit("short").alias("source"),
                    F.concat(F.lit("in Table "), F.col("p_size")).alias("text")),
        supplier.select(F.col("s_suppkey").alias("id"), F.lit("blank").alias("source"),
                        F.when(F.col("s_acctbal") < 0, "  ").otherwise("Series Type").alias("text")),
    ]
    rows = texts[0]
    for other in texts[1:]:
        rows = rows.unionByName(other)
    text = F.col("text")
    return rows.select(
        "id", "source", clean_text(text).alias("cleaned"),
        looks_like_series_id(text).alias("is_series_id"),
        looks_like_table_title(text).alias("is_title"), table_no(text).alias("table_no"),
    )


def release_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    styles = [
        F.concat(F.lit("Released: "), F.date_format(day, "MMMM yyyy")),
        F.concat(F.date_format(day, "yyyy"), F.lit(" - "), F.date_format(day, "MMM"), F.lit(" issue")),
        F.lower(F.date_format(day, "MMM-yyyy")), F.lit("not a release"),
    ]
    text = F.element_at(F.array(*styles), (F.col("o_orderkey") % len(styles) + 1).cast("int"))
    url = F.concat(F.lit(BASE_URL + "/orders/"), F.date_format(day, "MMM-yyyy"), F.lit("/a.xlsx?x=1"))
    month = release_month(text)
    return orders.select(
        "o_orderkey", month.alias("month"), release_key(month).alias("release"),
        release_from_url(url).alias("url_release"), release_page(url).alias("page"),
    )


def filename_and_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = inputs.part_index(spark, sf_dir)
    named = F.concat(F.col("page_url"), F.lit("/"), F.regexp_replace("cat_no", "[^0-9]", ""),
                     F.lpad(F.col("table_no"), 3, "0"), F.lit("_"), F.col("filename"), F.lit("?d=1#top"))
    pages = table(spark, sf_dir, "pages").select(
        (-F.col("page_id") - 1).alias("id"), F.lit("1").alias("cat_no"), "url",
        F.lit("cube of pages").alias("label"),
    )
    links = index.select(
        F.col("p_partkey").alias("id"), "cat_no", named.alias("url"), F.col("file_title").alias("label")
    ).unionByName(pages)
    url = without_query(absolute_url(F.col("url"), BASE_URL))
    return links.select(
        "id", url.alias("url"), url_filename(url).alias("filename"),
        extension(url_filename(url)).alias("extension"),
        file_type(url, F.col("label")).alias("file_type"),
        table_no_from_filename(F.col("cat_no"), url).alias("table_no"),
    )


# ---------------------------------------------------------------- cubes


def cube_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = stored_cells(inputs.nation_matrix_cells(spark, sf_dir))
    cube = cubes.read_cube(cells, "labelled_matrix", {"cat_no": "6202.0"})
    return cubes.dims_to_columns(cube, ["Status", "Nation_key"]).select(
        "source_file", "cat_no", "sheet", "date", "frequency", "value", "Status", "Nation_key"
    )


def cube_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = stored_cells(inputs.brand_sheet_cells(spark, sf_dir))
    wide = cubes.to_wide(cubes.generic_records(cells), ["Part", "Type", "Size"])
    return wide.select("sheet", "sheet_no", "row_no", "Part", "Type", "Size")


def cube_auto_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = stored_cells(
        inputs.nation_matrix_cells(spark, sf_dir) + inputs.brand_sheet_cells(spark, sf_dir)
    )
    names = ["Status", "Nation_key", "Part", "Type", "Size"]
    return cubes.dims_to_columns(cubes.read_cube(cells), names).select(
        "sheet", "date", "frequency", "value", *names
    )


def footer_and_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = stored_cells(inputs.supplier_footer_cells(spark, sf_dir))
    records = cubes.generic_records(cubes.without_notes(cells))
    # the text of a number is as its writer spelt it
    text = F.when(F.col("num").isNull(), F.col("text")).alias("text")
    return records.select("sheet", "row_no", "name", "num", text)


# ---------------------------------------------------------------- series


def series_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    key = F.lpad(F.col("s_suppkey").cast("string"), 7, "0")
    ids = supplier.where(F.col("s_acctbal") > 5000).select(
        F.concat(F.lit(" s"), key, F.lit(" ")).alias("series_id")
    )
    found = series.lookup_series(inputs.supplier_observations(spark, sf_dir), ids)
    return found.select("series_id", "sheet", "date", "l_returnflag", "value")


def family_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = catalogue.family_view(inputs.supplier_observations(spark, sf_dir), "awe")
    return found.select("cat_no", "series_id", "sheet", "date", "value")


def _part_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    sep = F.element_at(F.array(F.lit(" ; "), F.lit("|"), F.lit(", ")), F.col("p_size") % 3 + 1)
    total = F.when(F.col("p_size") % 2 == 0, "All  Groups").otherwise("Total")
    label = F.concat(
        F.col("p_type"), sep, total, sep, F.col("p_name"), sep,
        F.when(F.col("p_size") > 25, F.concat(F.col("p_brand"), sep)).otherwise(""),
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") != 13, label).alias("series")
    )


def separate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.separate_series(_part_labels(spark, sf_dir))


def separate_series_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.separate_series(_part_labels(spark, sf_dir), remove_totals=True)


def separate_series_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.separate_series(
        _part_labels(spark, sf_dir), names=["kind", "item", "brand"], remove_totals=True,
        drop_missing=True,
    )


def latest_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderpriority", F.to_date("o_orderdate").alias("date")
    )
    overall = series.latest_date(orders).withColumn("o_orderpriority", F.lit("any"))
    return series.latest_date(orders, by=["o_orderpriority"]).unionByName(overall)


def obs_with_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    observations = inputs.supplier_observations(spark, sf_dir)
    supplier = table(spark, sf_dir, "supplier")
    keys = observations.select("cat_no", "sheet", "series_id").distinct()
    meta = keys.join(
        supplier.select(
            F.concat(F.lit("S"), F.lpad(F.col("s_suppkey").cast("string"), 7, "0")).alias("series_id"),
            F.col("s_name").alias("series"),
        ),
        "series_id",
    )
    return timeseries.join_metadata(observations, meta).select(
        "cat_no", "sheet", "series_id", "date", "value", "series"
    )


# ---------------------------------------------------------------- catalogue


def catalogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.catalogues(inputs.part_index(spark, sf_dir), ["p_partkey"])


def search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.search_index(inputs.part_index(spark, sf_dir), " Widget 62").select("filename")


def search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = wide_table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("cat_no"), F.col("source").alias("title"),
        F.col("text").alias("description"), F.lit("document").alias("file_title"),
        F.lit("").alias("table_title"), F.col("doc_id").cast("string").alias("filename"),
    )
    return catalogue.search_index(documents, "Licen").select("doc_id")


def search_cubes(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = inputs.part_index(spark, sf_dir)
    return catalogue.search_cubes(index, "mar-202").select("cat_no", "filename")


def files_by_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = inputs.part_index(spark, sf_dir)
    return catalogue.files(index, " 6213.0 ").select("cat_no", "filename", "file_title")


def cube_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = inputs.part_index(spark, sf_dir)
    return catalogue.cube_files(index, release=" MAR-2021 ").select("cat_no", "filename")


def select_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    number = F.lpad((F.col("o_custkey") % 30 + 1).cast("string"), 2, "0")
    month = F.add_months(F.lit("2020-01-01").cast("date"), (F.col("o_orderkey") % 60).cast("int"))
    requests = orders.select(
        F.col("o_orderkey").alias("request_id"),
        F.concat(F.lit("62"), number, F.lit(".0")).alias("cat_no"),
        F.element_at(
            F.array(F.lit(None).cast("string"), F.lit("WIDGET"), F.lit("3")),
            (F.col("o_orderkey") % 3 + 1).cast("int"),
        ).alias("file"),
        F.when(F.col("o_totalprice") < 100000, F.upper(F.date_format(month, "MMM-yyyy"))).alias("release"),
        (F.col("o_orderstatus") == "P").alias("cube"),
    )
    found = catalogue.select_files(inputs.part_index(spark, sf_dir), requests)
    return found.select("request_id", "filename", "error")


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = month_of(F.col("o_orderdate"))
    cat_no = F.concat(F.lit("60"), F.ascii("o_orderstatus"), F.lit(".0"))
    rows = table(spark, sf_dir, "orders").select(
        cat_no.alias("cat_no"), F.col("o_orderpriority").alias("title"),
        month.alias("release_date"),
        F.concat(F.lit(BASE_URL + "/"), cat_no, F.lit("/"), release_key(month)).alias("release_url"),
        F.col("o_orderkey").alias("ord"),
    )
    return catalogue.distinct_releases(rows)


def nearest_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = table(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus").alias("cat_no"), F.to_date("l_shipdate").alias("requested")
    )
    known = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("cat_no"), F.to_date("o_orderdate").alias("release_date")
    )
    return catalogue.nearest_releases(requests, known)


def release_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.lpad((F.col("o_custkey") % 30 + 1).cast("string"), 2, "0")
    month = F.add_months(F.lit("2020-01-01").cast("date"), (F.col("o_orderkey") % 60).cast("int"))
    requests = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("62"), number, F.lit(".0")).alias("cat_no"), month.alias("release_month")
    )
    return catalogue.release_files(inputs.part_index(spark, sf_dir), requests).select(
        "cat_no", "release_month", "filename"
    )


# ---------------------------------------------------------------- pages


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = page_source.page_links(wide_table(spark, sf_dir, "pages").select("page_id", "html"))
    return links.select(
        "page_id", "ord", "label", absolute_url(F.col("href"), BASE_URL).alias("url")
    )


def page_best_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = page_source.page_links(wide_table(spark, sf_dir, "pages").select("page_id", "html"))
    scored = links.withColumn("score", title_score(F.col("label")))
    return scored.groupBy("page_id").agg(
        F.max_by(F.struct("href", "label", "score"), F.struct("score", "ord")).alias("best")
    ).select("page_id", "best.*")


def page_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = wide_table(spark, sf_dir, "pages").select("page_id", "html")
    return page_source.page_attributes(pages)


def page_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links found by the page parser, whole documents, compared with the expression form."""
    outlines = page_source.page_outlines(wide_table(spark, sf_dir, "pages"), contexts=False)
    return outlines.select("page_id", F.inline("links")).select(
        "page_id", "href", collapse(F.col("label")).alias("label"),
        is_generic_label(F.col("label")).alias("is_generic"),
    )


PART_PAGE = (
    '<html><head><meta name="description" content="Parts of {brand}"></head><body>'
    "<h1>{brand} statistics</h1><section class=\"downloads\"><table>"
    '<tr><td>Table {size}. {name}</td><td><a href="{path}/apr-2024/t{key}.xlsx?download=1">'
    "Download xlsx [1 KB]</a></td></tr>"
    '<tr><td>Table {size}. {name}</td><td><a href="{path}/apr-2024/t{key}.xlsx">'
    "Download xlsx [1 KB]</a></td></tr></table></section>"
    '<ul class="downloads"><li>{type} data cube &amp; more <a href="{path}/apr-2024/c{key}.xls">'
    "Download xls</a></li></ul></body></html>"
)


def _part_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One catalogue page per part and the seed it belongs to."""
    return _pages_of_parts(wide_table(spark, sf_dir, "part"))


def _pages_of_parts(part: DataFrame) -> tuple[DataFrame, DataFrame]:
    path = F.concat(F.lit("/parts/"), F.col("p_partkey").cast("string"))
    html: Column = F.lit(PART_PAGE)
    for field, value in {
        "brand": F.col("p_brand"), "size": F.col("p_size").cast("string"), "name": F.col("p_name"),
        "type": F.col("p_type"), "key": F.col("p_partkey").cast("string"), "path": path,
    }.items():
        html = F.replace(html, F.lit("{" + field + "}"), value)
    page_url = F.concat(F.lit(BASE_URL), path)
    pages = part.select(
        F.col("p_partkey").alias("page_id"), page_url.alias("url"), html.alias("html")
    )
    return pages, _seeds(part.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("cat_no"),
        F.col("p_name").alias("title"), page_url.alias("page_url"),
    ))


def _seeds(rows: DataFrame) -> DataFrame:
    return rows.select(
        "cat_no", "title", F.lit("Seed description").alias("description"), "page_url",
        F.lit("Seed file").alias("file_title"),
        F.concat(F.col("page_url"), F.lit("/jan-2020/seed.xlsx")).alias("url"),
        F.lit("seed.xlsx").alias("filename"), F.lit("1").alias("table_no"),
        F.lit(True).alias("is_timeseries"), F.lit(False).alias("is_cube"),
    )


def discover_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, seeds = _part_pages(spark, sf_dir)
    found = discovery.discover_files(pages, seeds, BASE_URL)
    return found.select(
        "cat_no", "title", "description", "release_date", "file_title", "url", "filename",
        "file_type", "table_no", "table_title", "is_timeseries", "is_cube",
    )


def link_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, _ = _part_pages(spark, sf_dir)
    return discovery.link_contexts(page_source.page_outlines(pages), BASE_URL)


def _customer_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Landing and archive page per customer; a debit balance has no dated link at all."""
    customer = wide_table(spark, sf_dir, "customer")
    path = F.concat(F.lit("/customers/"), F.col("c_custkey").cast("string"))
    month = F.add_months(F.lit("2015-01-01").cast("date"), F.col("c_nationkey"))
    earlier = F.add_months(month, -3)

    def link(href: Column, label: Column) -> Column:
        return F.concat(F.lit('<p><a href="'), href, F.lit('">'), label, F.lit("</a></p>"))

    dated = link(
        F.concat(path, F.lit("/"), release_key(month)),
        F.concat(F.lit("Customers "), F.date_format(month, "MMMM yyyy")),
    )
    archive = link(F.concat(path, F.lit("/archive")), F.lit("Past releases"))
    landing = F.concat(F.when(F.col("c_acctbal") >= 0, dated).otherwise(""), archive)
    older = F.when(
        F.col("c_acctbal") >= 0,
        link(F.concat(path, F.lit("/"), release_key(earlier), F.lit("/all")), F.lit("Earlier")),
    ).otherwise("<p>none</p>")
    page_url = F.concat(F.lit(BASE_URL), path)
    key = F.col("c_custkey")
    pages = customer.select(
        (key * 2).alias("page_id"), page_url.alias("url"), landing.alias("html")
    ).unionByName(
        customer.select(
            (key * 2 + 1).alias("page_id"), F.concat(page_url, F.lit("/archive")).alias("url"),
            older.alias("html"),
        )
    )
    seeds = _seeds(customer.select(
        F.concat(F.lit("C"), key.cast("string")).alias("cat_no"), F.col("c_name").alias("title"),
        page_url.alias("page_url"),
    ))
    return pages, seeds


def discover_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, seeds = _customer_pages(spark, sf_dir)
    return discovery.discover_releases(pages, seeds, BASE_URL)


# ---------------------------------------------------------------- SDMX


def sdmx_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = wide_table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    json = F.format_string(
        '{"structure":{"dimensions":{"series":[{"id":"PRIORITY","values":[{"id":"none"},{"id":"%s"}]},'
        '{"id":"STATUS","values":[{"id":"%s"}]}],'
        '"observation":[{"id":"TIME_PERIOD","values":[{"id":"%s"},{"id":"%s"}]}]}},'
        '"dataSets":[{"series":{"1:0":{"observations":{"0":[%s],"1":["%s"],"9":[null]}}}}]}',
        F.col("o_orderpriority"), F.col("o_orderstatus"), F.date_format("o_orderdate", "yyyy-MM"),
        F.concat(F.year("o_orderdate").cast("string"), F.lit("-Q"), F.quarter("o_orderdate")),
        price, price,
    )
    documents = orders.select("o_orderkey", json.alias("json"))
    found = sdmx.observations(documents)
    return cubes.dims_to_columns(found, ["PRIORITY", "STATUS"])


def sdmx_json_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = wide_table(spark, sf_dir, "events")
    trees = events.select(
        F.col("event_id").alias("doc_id"),
        F.try_parse_json(F.concat(F.lit('{"a":[{"b":'), F.col("props"), F.lit("}]}"))).alias("tree"),
    )
    found = sdmx.collect_named(trees, ["k"])
    return found.select(
        F.col("doc_id").alias("event_id"), F.try_variant_get("node", "$", "bigint").alias("k")
    )


def dataflows(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = wide_table(spark, sf_dir, "customer")
    json = F.format_string(
        '{"data":{"dataflows":[{"id":"%s_%s","name":{"en":"%s"},"description":"Flow"},{"name":"x"}]}}',
        F.col("c_mktsegment"), F.col("c_nationkey"), F.lower("c_mktsegment"),
    )
    return sdmx.dataflows(customer.select(F.col("c_custkey").alias("doc_id"), json.alias("json")))


def _nation_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A data structure per region: its nations by code list, segments inline, a free one.

    Nation and region are reference tables of fixed size, so a document stays small.
    """
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    items = F.transform(
        F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))),
        lambda n: F.format_string(
            '{"id":"N%s","name":{"en":"%s"}}', n["n_nationkey"], n["n_name"]
        ),
    )
    lists = nation.groupBy("n_regionkey").agg(F.array_join(items, ",").alias("items"))
    json = F.format_string(
        '{"data":{"dataStructures":[{"dataStructureComponents":{"dimensionList":{"dimensions":['
        '{"id":"SEG","name":"Market segment","position":"1","values":[{"id":"1","name":"AUTOMOBILE"},'
        '{"id":"2","name":"BUILDING"},{"id":"3","name":"FURNITURE"},{"id":"4"}]},'
        '{"id":"NATION","name":{"en":"Nation of %s"},"position":0,'
        '"localRepresentation":{"enumeration":{"id":"CL"}}},{"id":"FREE","name":"Free"}]}}}],'
        '"codelists":[{"id":"CL","items":[%s]}]}}',
        F.col("r_name"), F.col("items"),
    )
    documents = region.join(lists, F.col("r_regionkey") == F.col("n_regionkey")).select(
        F.col("r_regionkey").cast("bigint").alias("doc_id"), json.alias("json")
    )
    return sdmx.datastructure(documents)


def datastructure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nation_structure(spark, sf_dir)


def api_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    located = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("request_id"), F.col("n_regionkey").cast("bigint").alias("doc_id"),
        "n_name", "n_nationkey", "c_mktsegment", "c_acctbal",
    )
    key = ["request_id", "doc_id"]

    def filter_rows(df: DataFrame, ord_: int, name: str, code_ord: int, code: Column) -> DataFrame:
        return df.select(
            *key, F.lit(ord_).alias("ord"), F.lit(name).alias("name"),
            F.lit(code_ord).alias("code_ord"), code.cast("string").alias("code"),
        )

    rich, poor = located.where(F.col("c_acctbal") >= 0), located.where(F.col("c_acctbal") < 0)
    requests = (
        filter_rows(rich, 0, "nation", 0, F.lower("n_name"))
        .unionByName(filter_rows(rich, 0, "nation", 1, F.concat(F.lit("n"), F.col("n_nationkey"))))
        .unionByName(filter_rows(rich, 1, "Market_Segment", 0, F.col("c_mktsegment")))
        .unionByName(
            poor.select(*key, F.lit(0).alias("ord"), F.lit(None).cast("string").alias("name"),
                        F.lit(0).alias("code_ord"), F.lit("").alias("code"))
        )
    )
    structure = stage(_nation_structure(spark, sf_dir), "structure")
    return sdmx.api_keys(structure, requests)


def dimension_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    observations = inputs.supplier_observations(spark, sf_dir)
    flags = observations.select("l_returnflag", "l_linestatus").distinct()

    def codes(column: str, name: str, position: int, label: Column) -> DataFrame:
        return flags.select(
            F.lit(1).alias("doc_id"), F.lit(column).alias("dimension_id"),
            F.lit(name).alias("dimension_name"), F.lit(position).alias("position"),
            F.col(column).alias("code"), label.alias("label"),
            F.ascii(column).alias("code_position"),
        ).distinct()

    structure = codes(
        "l_returnflag", "Return flag", 1, F.when(F.col("l_returnflag") == "R", "Returned")
    ).unionByName(codes("l_linestatus", "Status", 2, F.lit(None).cast("string")))
    structure = stage(structure, "structure")
    mapped = observations.withColumn(
        "dims",
        F.create_map(F.lit("l_returnflag"), F.col("l_returnflag"),
                     F.lit("l_linestatus"), F.col("l_linestatus")),
    )
    found = sdmx.filter_observations(
        mapped, structure, {"return_flag": ["returned", "a"], "STATUS": "f"}, "1996-Q2", "1998"
    )
    return found.select("series_id", "date", "l_returnflag", "value")


# ---------------------------------------------------------------- sets and ingest


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("supplier")
    )
    return customer.unionByName(supplier, allowMissingColumns=True)


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select(
        "doc_id",
        F.concat(F.lit("/lake/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"),
                 F.lit(".xlsx")).alias("path"),
        F.col("n_chars").alias("length"),
        F.timestamp_seconds(F.col("doc_id") + 1_700_000_000).alias("modificationTime"),
    )


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_inventory(_manifest(spark, sf_dir), "/lake").select(
        "kind", "file", "path", "size", F.unix_seconds("modified").alias("modified")
    )


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose stored version is missing or older than the current one."""
    current = incremental.with_fingerprint(_manifest(spark, sf_dir), options={"tables": None})
    labels = table(spark, sf_dir, "labels")
    stored = _manifest(spark, sf_dir).join(labels, "doc_id").withColumn(
        "length", F.col("length") + F.when(F.col("quality") == 1, 0).otherwise(1)
    )
    ingested = incremental.with_fingerprint(
        stored.select("path", "length", "modificationTime"), options={"tables": None}
    )
    return incremental.pending_sources(current, ingested).select("doc_id", "path", "fingerprint")


def workbook_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of all workbooks; of a broken sheet nothing."""
    cells, _ = parse_workbooks(stage(books.order_books(spark, sf_dir), "landing"))
    # the text of a number is as its writer spelt it
    text = F.when(F.col("kind") == "s", F.col("text")).alias("text")
    return cells.select(
        "source_file", "sheet_no", "sheet", "row_no", "col_no", "kind", text, "num", "date"
    )


def workbook_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sheet that can be opened, one per file that can't."""
    _, sheets = parse_workbooks(stage(books.order_books(spark, sf_dir), "landing"))
    return sheets.select(
        "source_file", "sheet_no", "sheet", "n_cells", F.col("error").isNotNull().alias("is_broken")
    )


def workbook_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of one table of each workbook; other sheets are not parsed."""
    cells, _ = parse_workbooks(stage(books.order_books(spark, sf_dir), "landing"), tables=["status p"])
    return cells.groupBy("source_file", "sheet_no", "sheet").agg(F.count(F.lit(1)).alias("n_cells"))


def sheet_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets_of(stage(books.order_books(spark, sf_dir), "landing"))


def ingest_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings of the same workbooks, every third one changed in the second: which run read
    what is stored now, and what it holds."""
    store = f"{staging_root(spark)}/gridtide/ingest-{uuid.uuid4().hex}"
    changed = F.when(F.col("book") % 3 == 0, 2).otherwise(1)
    listing = None
    for run, version in (("first", F.lit(1)), ("second", changed)):
        landed = stage(books.order_books(spark, sf_dir, version), "landing")

        def contents(paths: list[str], landed: DataFrame = landed) -> DataFrame:
            return landed.where(F.col("path").isin(paths)).select("path", "content")

        listing = landed.drop("content")
        incremental.ingest(spark, listing, contents, store, run=run)
    files = incremental.current_files(spark, listing, store)
    total = incremental.current_cells(spark, listing, store).where("col_no = 4").groupBy(
        F.col("source_file").alias("path")
    ).agg(F.sum("num").alias("total"))
    return files.join(total, "path", "left").select(
        "path", "run", "n_sheets", "n_cells", "n_errors", F.round("total", 2).alias("total")
    )


def release_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of releases given as dates, or why there are none."""
    orders = table(spark, sf_dir, "orders")
    number = F.lpad((F.col("o_custkey") % 30 + 1).cast("string"), 2, "0")
    month = F.add_months(F.lit("2020-01-01").cast("date"), (F.col("o_orderkey") % 60).cast("int"))
    requests = orders.select(
        F.col("o_orderkey").alias("request_id"),
        F.concat(F.lit("62"), number, F.lit(".0")).alias("cat_no"),
        F.lit(None).cast("string").alias("file"), F.lit(None).cast("string").alias("release"),
        F.date_add(month, 14).alias("release_day"), F.lit(False).alias("cube"),
    )
    found = catalogue.select_files(inputs.part_index(spark, sf_dir), requests)
    return found.select("request_id", "filename", "error")


def _flag_files(cells: DataFrame, prefix: str) -> DataFrame:
    """Cells with a file for each return flag."""
    number = (F.col("sheet_no") % 100).cast("string")
    return cells.withColumn("source_file", F.concat(F.lit(prefix + "-"), number, F.lit(".xlsx")))


def _flag_index(spark: SparkSession, sf_dir: str, prefix: str, is_cube: bool) -> DataFrame:
    """Index rows of those files: one catalogue, a release each, the later the flag the later."""
    flags = table(spark, sf_dir, "lineitem").select("l_returnflag").distinct()
    number = (F.ascii("l_returnflag") - F.ascii(F.lit("A")) + 1).cast("string")
    month = F.add_months(F.lit("2020-01-01").cast("date"), F.ascii("l_returnflag"))
    null = F.lit(None).cast("string")
    filename = F.concat(F.lit(prefix + "-"), number, F.lit(".xlsx"))
    return flags.select(
        F.lit("6202.0").alias("cat_no"), F.lit("Line items").alias("title"), null.alias("description"),
        null.alias("page_url"), release_key(month).alias("release_date"),
        F.concat(F.lit("Flag "), "l_returnflag").alias("file_title"),
        F.concat(F.lit(BASE_URL + "/"), filename).alias("url"), filename.alias("filename"),
        F.lit("xlsx").alias("file_type"), null.alias("table_no"), null.alias("table_title"),
        F.lit(not is_cube).alias("is_timeseries"), F.lit(is_cube).alias("is_cube"),
    )


def _flag_requests(spark: SparkSession, sf_dir: str, is_cube: bool) -> DataFrame:
    """A request by title for each flag, one for the latest release, one for a month without."""
    flags = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag")).distinct()
    by_title = flags.select(
        F.ascii("flag").alias("request_id"), F.concat(F.lit("flag "), F.lower("flag")).alias("file"),
        F.lit(None).cast("date").alias("release_day"),
    )
    others = spark.createDataFrame([(1, None, None), (2, None, datetime.date(1999, 1, 5))], by_title.schema)
    return by_title.unionByName(others).select(
        "request_id", F.lit("6202.0").alias("cat_no"), "file", F.lit(None).cast("string").alias("release"),
        "release_day", F.lit(is_cube).alias("cube"),
    )


def request_to_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations of requested files, with what the index says about each."""
    cells = _flag_files(stored_cells(inputs.supplier_month_cells(spark, sf_dir)), "lineitem")
    found = requests.read_requests(
        cells, _flag_index(spark, sf_dir, "lineitem", False), _flag_requests(spark, sf_dir, False)
    )
    return found.select(
        "request_id", "source_file", "cat_no", "release_date", "sheet", "date", "series_id", "value"
    )


def cube_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cubes of requested files, each row with the provenance of its file."""
    cells = _flag_files(stored_cells(inputs.nation_matrix_cells(spark, sf_dir)), "matrix")
    found = requests.read_requested_cubes(
        cells, _flag_index(spark, sf_dir, "matrix", True), _flag_requests(spark, sf_dir, True),
        family="labelled_matrix",
    )
    named = cubes.dims_to_columns(found, ["Status", "Nation_key"])
    return named.select(
        "request_id", "source_file", "cat_no", "release_date", "cube", "cube_title", "date", "value",
        "Status", "Nation_key",
    )


def refresh_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of all catalogues after pages landed twice and every second one changed later."""
    store = f"{staging_root(spark)}/gridtide/index-{uuid.uuid4().hex}"
    part = table(spark, sf_dir, "part")

    def landing(rows: DataFrame, number: int) -> tuple[DataFrame, DataFrame]:
        pages, seeds = _pages_of_parts(spread(rows))
        own = pages.withColumn("page_id", F.col("page_id") + number * 10**12)
        return own.withColumn("landed", F.lit(number)), seeds

    older, seeds = landing(part.withColumn("p_size", F.col("p_size") + 100), 1)
    newer, _ = landing(part, 2)
    rebuild.refresh_index(spark, newer.unionByName(older), seeds, BASE_URL, store)
    even = part.where(F.col("p_partkey") % 2 == 0).withColumn("p_size", F.col("p_size") + 1)
    later, some = landing(even, 3)
    rebuild.refresh_index(spark, newer.unionByName(later), some, BASE_URL, store)
    return rebuild.stored_rows(spark, store).select("cat_no", "file_title", "url", "table_no", "is_cube")


def refresh_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases of all catalogues as a refresh stores them."""
    store = f"{staging_root(spark)}/gridtide/index-{uuid.uuid4().hex}"
    pages, seeds = _customer_pages(spark, sf_dir)
    rebuild.refresh_index(spark, pages.withColumn("landed", F.lit(1)), seeds, BASE_URL, store)
    return rebuild.stored_rows(spark, store, "releases")


def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored file index, the releases of one month of which were written again."""
    store = f"{staging_root(spark)}/gridtide/index-{uuid.uuid4().hex}"
    index = inputs.part_index(spark, sf_dir).select(*FILE_INDEX.names)
    inventory.write_index(index, store)
    again = index.where(F.col("release_date").startswith("mar-"))
    inventory.write_index(again.withColumn("title", F.upper("title")).withColumn(
        "table_title", F.lit(None).cast("string")), store)
    return inventory.read_stored_index(spark, store).select(
        "cat_no", "title", "release_date", "filename", "table_title"
    )


def unknown_catalogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that ask for a catalogue no part belongs to."""
    number = F.lpad((F.col("o_custkey") % 60).cast("string"), 2, "0")
    asked = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit(" 62"), number, F.lit(".0 ")).alias("cat_no")
    )
    seeds = inputs.part_index(spark, sf_dir).select("cat_no")
    return catalogue.unknown_catalogues(asked, seeds).select("o_orderkey")


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as JSON files, read as whole documents."""
    path = f"{staging_root(spark)}/gridtide/json-{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events")
    body = F.to_json(F.struct("event_id", "event_type", "props")).alias("value")
    events.select(body).write.text(path)
    docs = inventory.json_documents(spark, path)
    # a file holds a document per line here
    line = F.explode(F.split(F.regexp_replace("json", "\n+$", ""), "\n")).alias("line")
    fields = F.from_json("line", "event_id BIGINT, event_type STRING, props STRING")
    return docs.select("doc_id", line).select(fields.alias("f")).select("f.*")


def sheet_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the sheets with given names."""
    cells = stored_cells(inputs.supplier_label_cells(spark, sf_dir))
    names = [f"Nation {i}" for i in range(0, 25, 3)]
    return select_sheets(cells, names).select("source_file", "sheet", "row_no", "col_no", "text")


def ordered_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each code in the order that the operator gives."""
    ordered = sdmx.ordered_structure(_nation_structure(spark, sf_dir)).withColumn("ord", F.monotonically_increasing_id())
    place = F.row_number().over(W.partitionBy("doc_id").orderBy("ord"))
    return ordered.select("doc_id", "dimension_id", "code", place.alias("place"))


QUERIES: dict[str, Query] = {
    "tidy_time_down": tidy_time_down,
    "tidy_time_across": tidy_time_across,
    "tidy_fallback_mixed": tidy_fallback_mixed,
    "tidy_no_metadata": tidy_no_metadata,
    "series_metadata": series_metadata,
    "metadata_only": metadata_only,
    "sheet_context": context_of_sheets,
    "table_match": table_match,
    "raw_sheet": raw_sheet,
    "period_parse": period_parse,
    "number_parse": number_parse,
    "frequency_infer": frequency_infer,
    "frequency_normalise": frequency_normalise,
    "key_and_name_normalise": key_and_name_normalise,
    "layout_predicates": layout_predicates,
    "release_text": release_text,
    "filename_and_type": filename_and_type,
    "cube_matrix": cube_matrix,
    "cube_generic": cube_generic,
    "cube_auto_fallback": cube_auto_fallback,
    "footer_and_notes": footer_and_notes,
    "series_lookup": series_lookup,
    "family_view": family_view,
    "separate_series": separate_series,
    "separate_series_totals": separate_series_totals,
    "separate_series_drop": separate_series_drop,
    "latest_date": latest_date,
    "obs_with_meta": obs_with_meta,
    "catalogues": catalogues,
    "search_index": search_index,
    "search_documents": search_documents,
    "search_cubes": search_cubes,
    "files_by_catalogue": files_by_catalogue,
    "cube_files": cube_files,
    "select_file": select_file,
    "releases": releases,
    "nearest_release": nearest_release,
    "release_files": release_files,
    "page_links": page_links,
    "page_best_link": page_best_link,
    "page_attributes": page_attributes,
    "page_outline": page_outline,
    "discover_files": discover_files,
    "link_context": link_context,
    "discover_releases": discover_releases,
    "sdmx_observations": sdmx_observations,
    "sdmx_json_map": sdmx_json_map,
    "dataflows": dataflows,
    "datastructure": datastructure,
    "api_key": api_key,
    "dimension_filter": dimension_filter,
    "union_by_name": union_by_name,
    "source_inventory": source_files,
    "incremental_ingest": incremental_ingest,
    "refresh_index": refresh_index,
    "refresh_releases": refresh_releases,
    "index_rows": index_rows,
    "unknown_catalogues": unknown_catalogues,
    "json_documents": json_documents,
    "sheet_selection": sheet_selection,
    "ordered_structure": ordered_structure,
    "release_by_date": release_by_date,
    "request_to_obs": request_to_obs,
    "cube_provenance": cube_provenance,
    "workbook_cells": workbook_cells,
    "workbook_sheets": workbook_sheets,
    "workbook_tables": workbook_tables,
    "sheet_names": sheet_names,
    "ingest_changed": ingest_changed,
}
