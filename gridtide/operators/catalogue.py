"""Catalogue, file and release index: filters, search, selection."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window as W

from gridtide.functions.releases import release_key, release_month
from gridtide.functions.text import strip
from gridtide.operators.containment import containing
from gridtide.schemas import CATALOGUES, FAMILIES, FILE_INDEX

SEARCH_FIELDS = ["cat_no", "title", "description", "file_title", "table_title", "filename"]

REQUEST = "request_id INT, cat_no STRING, file STRING, release STRING, cube BOOLEAN"


def key(text: Column) -> Column:
    return F.lower(strip(text))


def files(index: DataFrame, cat_no: str | None = None) -> DataFrame:
    """All files, or those of one catalogue in any case."""
    if cat_no is None:
        return index
    return index.where(F.lower("cat_no") == str(cat_no).strip().lower())


def _search(index: DataFrame, query: str, fields: list[str]) -> DataFrame:
    needle = query.strip().lower()
    if not needle:
        return index
    return index.where(F.lower(F.concat_ws(" ", *fields)).contains(needle))


def search_index(index: DataFrame, query: str) -> DataFrame:
    """Files whose catalogue and file texts contain the query."""
    return _search(index, query, SEARCH_FIELDS)


def search_cubes(index: DataFrame, query: str, cat_no: str | None = None) -> DataFrame:
    """As :func:`search_index` over data cubes, the URL included."""
    return _search(cube_files(index, cat_no), query, [*SEARCH_FIELDS, "url"])


def cube_files(
    index: DataFrame, cat_no: str | None = None, release: str | datetime.date | None = None
) -> DataFrame:
    """Data cubes of a catalogue, of a release key or of a release month."""
    found = files(index, cat_no).where("is_cube")
    if release is None:
        return found
    if isinstance(release, datetime.date):
        if cat_no is None:
            raise ValueError("cat_no is required when release is a date")
        month = F.lit(release).cast("date")
        return found.where(F.lower("release_date") == release_key(month))
    return found.where(F.lower("release_date") == str(release).strip().lower())


def catalogues(index: DataFrame, order: list[str]) -> DataFrame:
    """One row per catalogue with the attributes of its first index row.

    ``order`` names the columns that define which row is first.
    """
    attributes = F.struct("title", "description", "page_url")
    return (
        index.groupBy("cat_no")
        .agg(F.min_by(attributes, F.struct(*order)).alias("first"))
        .select("cat_no", "first.*", F.lit(True).alias("supported"))
        .select(*CATALOGUES)
    )


def unknown_catalogues(requests: DataFrame, seeds: DataFrame) -> DataFrame:
    """Requested catalogues no seed knows."""
    keyed = requests.withColumn("_cat", strip(F.col("cat_no")))
    known = seeds.select(strip(F.col("cat_no")).alias("_cat")).distinct()
    return keyed.join(known, "_cat", "left_anti").drop("_cat")


# ---------------------------------------------------------------- file selection


def _candidates(index: DataFrame) -> DataFrame:
    """Index rows per kind with their sort order inside a catalogue."""
    month = release_month(F.col("release_date"))
    row = F.struct(*FILE_INDEX.names)
    # Later months first; rows without one last.
    age = F.coalesce(-F.unix_date(month), F.lit(2**31 - 1))
    kinds = F.array_compact(
        F.array(F.when(F.col("is_cube"), True), F.when(F.col("is_timeseries"), False))
    )
    other_table = F.coalesce((F.col("table_no") != "1").cast("int"), F.lit(1))
    return index.select(
        key(F.col("cat_no")).alias("cat_key"),
        key(F.col("release_date")).alias("release_key"),
        F.explode(kinds).alias("cube"),
        F.lower("file_title").alias("title_key"),
        F.lower("filename").alias("filename_key"),
        F.lower("table_no").alias("table_key"),
        # names given as such: beside a generator Spark drops the aliases of what is not resolved yet
        F.named_struct(
            F.lit("age"), age, F.lit("filename"), F.col("filename"), F.lit("row"), row
        ).alias("ranked"),
        other_table.alias("other_table"),
    )


def select_files(index: DataFrame, requests: DataFrame) -> DataFrame:
    """Best file of each request, or the reason why there is none.

    ``requests`` has ``request_id, cat_no, file, release, cube``: ``file`` (or null) is a
    text inside title or file name, or a table number; ``release`` (or null for the
    latest) a key like ``apr-2024``. A column ``release_day`` may give the release as a date
    instead, which stands for its month; if the catalogue has none in that month, the reason names
    the nearest ones. Later releases win, then the file name; a time-series request without
    ``file`` prefers table 1.

    Requests without ``file`` meet one pre-aggregated row per catalogue or release, never all
    files of a catalogue; texts are looked up in an index of their parts, table numbers by
    equality. Requests that say the same are answered once.
    """
    candidates = _candidates(index)
    day = F.col("release_day").cast("date") if "release_day" in requests.columns else F.lit(None).cast("date")
    wanted = requests.select(
        "request_id", "cat_no",
        key(F.col("cat_no")).alias("cat_key"),
        F.coalesce(release_key(F.trunc(day, "month")), key(F.col("release"))).alias("release_key"),
        day.alias("release_day"), "cube", key(F.col("file")).alias("file_key"),
    )
    kind, dated = ["cat_key", "cube"], ["cat_key", "cube", "release_key"]
    best = F.min("ranked").alias("best")

    table_first = F.when(F.col("cube"), 0).otherwise(F.col("other_table"))
    preferred = F.min(F.struct(table_first.alias("t"), "ranked"))["ranked"].alias("best")
    by_kind = candidates.groupBy(*kind).agg(preferred)
    by_release = candidates.groupBy(*dated).agg(preferred)
    open_file, latest = F.col("file_key").isNull(), F.col("release_key").isNull()
    plain = wanted.where(open_file & latest).join(by_kind, kind)
    at_release = wanted.where(open_file & ~latest).join(by_release, dated)

    spec = [*dated, "file_key"]
    specs = wanted.where(~open_file).select(*spec).distinct()
    # what a request can name: texts to look inside, table numbers, and (blank) anything
    titles = F.array("title_key", "filename_key")
    named = candidates.select(*dated, "ranked", F.explode(titles).alias("text")).where("text is not null")
    tables = candidates.select(*dated, "ranked", F.col("table_key").alias("text"))
    needles = specs.select(*kind, F.col("file_key").alias("needle"))
    inside = containing(named, needles, kind)

    def answers(rows: DataFrame, names: DataFrame) -> DataFrame:
        """Best file of each spec, from rows by ``text`` and the texts each ``needle`` names."""
        of = names.withColumnRenamed("needle", "file_key")
        # a row per text of the index: as many as files, too many to broadcast
        newest = rows.groupBy(*kind, "text").agg(best).hint("merge").join(of, [*kind, "text"])
        undated = specs.where(latest).join(newest, [*kind, "file_key"])
        monthly = rows.groupBy(*dated, "text").agg(best).hint("merge").join(of, [*kind, "text"])
        at_month = specs.where(~latest).join(monthly, spec)
        return undated.select(*spec, "best").unionByName(at_month.select(*spec, "best"))

    blank = named.withColumn("text", F.lit(""))
    same_text = needles.withColumn("text", F.col("needle"))
    found = (
        answers(named, inside)
        .unionByName(answers(tables, same_text.distinct()))
        .unionByName(answers(blank, same_text.where("needle = ''").distinct()))
        .groupBy(*spec).agg(F.min("best").alias("best"))
    )
    asked = wanted.where(~open_file)
    same = [asked[name].eqNullSafe(found[name]) for name in spec]
    by_file = asked.hint("merge").join(found, same).select(asked["request_id"], found["best"])

    chosen = (
        plain.select("request_id", "best")
        .unionByName(at_release.select("request_id", "best"))
        .unionByName(by_file)
        .select("request_id", F.col("best.row").alias("found"))
    )
    known = by_kind.groupBy("cat_key").agg(F.lit(True).alias("has_cat"))
    status = (
        wanted.join(chosen, "request_id", "left")
        .join(known, "cat_key", "left")
        .join(by_kind.select(*kind, F.lit(True).alias("has_kind")), kind, "left")
        .join(by_release.select(*dated, F.lit(True).alias("has_release")), dated, "left")
    )
    no_release = F.lit("no files for release")
    if "release_day" in requests.columns:
        months = index.select(
            key(F.col("cat_no")).alias("cat_no"), release_month(F.col("release_date")).alias("release_date")
        )
        missing = status.where(F.col("release_day").isNotNull() & F.col("has_release").isNull())
        told = missing_release_messages(
            missing.select(F.col("cat_key").alias("cat_no"), F.col("release_day").alias("requested")), months
        )
        of = (status["cat_key"] == told["cat_no"]) & (status["release_day"] == told["requested"])
        status = status.join(told.select("cat_no", "requested", "message"), of, "left").drop(told["cat_no"])
        no_release = F.coalesce("message", no_release)
    error = (
        F.when(F.col("found").isNotNull(), None)
        .when(F.col("has_cat").isNull(), "no files for catalogue")
        .when(F.col("has_kind").isNull(), "no files of this kind")
        .when(~latest & F.col("has_release").isNull(), no_release)
        .otherwise("no file matched")
    )
    return status.select(
        "request_id",
        *[F.col(f"found.{name}").alias(name) for name in FILE_INDEX.names],
        error.alias("error"),
    )


def select_file(
    index: DataFrame,
    cat_no: str,
    file: str | None = None,
    release: str | None = None,
    cube: bool = False,
) -> DataFrame:
    """The one-request form of :func:`select_files`."""
    spark = index.sparkSession
    return select_files(index, spark.createDataFrame([(1, cat_no, file, release, cube)], REQUEST))


def family_request(
    spark: SparkSession, family: str, selector: str | None = None, release: str | None = None
) -> tuple[DataFrame, bool]:
    """The request that a named family stands for, and whether it is for a cube. ``selector``
    names the cube of a cube family; time-series families have one workbook."""
    cat_no, kind, default = _family(family)
    is_cube = kind == "cube"
    file = (selector or default) if is_cube else None
    request = spark.createDataFrame([(1, cat_no, file, release, is_cube)], REQUEST)
    return request, is_cube


def family_files(
    index: DataFrame, family: str, selector: str | None = None, release: str | None = None
) -> DataFrame:
    """File of a named family such as "cpi" or "lfs_cube"."""
    request, _ = family_request(index.sparkSession, family, selector, release)
    return select_files(index, request)


def family_view(observations: DataFrame, family: str) -> DataFrame:
    """Observations of a named family."""
    return observations.where(F.col("cat_no") == _family(family)[0])


def _family(family: str) -> tuple[str, str, str | None]:
    if family not in FAMILIES:
        raise ValueError(f"unknown family {family!r}; known are {', '.join(sorted(FAMILIES))}")
    return FAMILIES[family]


# ---------------------------------------------------------------- releases


def distinct_releases(rows: DataFrame) -> DataFrame:
    """Releases per catalogue: the last row of each URL (by ``ord``) counts."""
    last = F.max_by(F.struct("title", "release_date"), "ord")
    return (
        rows.groupBy("cat_no", "release_url")
        .agg(last.alias("last"))
        .select("cat_no", "last.title", "last.release_date", "release_url")
    )


def release_files(index: DataFrame, requests: DataFrame, strict: bool = False) -> DataFrame:
    """Files of the requested release months (``cat_no``, ``release_month``).

    ``strict`` also gives a row for each request without files: ``error`` says so and names the
    nearest releases, the columns of the index are null.
    """
    dated = index.withColumns(
        {
            "cat_key": key(F.col("cat_no")),
            "release_month": release_month(F.col("release_date")),
        }
    )
    wanted = requests.select(
        key(F.col("cat_no")).alias("cat_key"), F.col("release_month").cast("date")
    ).distinct()
    found = dated.join(wanted, ["cat_key", "release_month"])
    if not strict:
        return found.drop("cat_key")
    left = wanted.join(dated, ["cat_key", "release_month"], "left_anti")
    months = dated.select(F.col("cat_key").alias("cat_no"), F.col("release_month").alias("release_date"))
    told = missing_release_messages(
        left.select(F.col("cat_key").alias("cat_no"), F.col("release_month").alias("requested")), months
    ).select("cat_no", F.col("requested").alias("release_month"), F.col("message").alias("error"))
    return found.drop("cat_key").withColumn("error", F.lit(None).cast("string")).unionByName(
        told, allowMissingColumns=True
    )


def missing_release_messages(requests: DataFrame, releases: DataFrame) -> DataFrame:
    """(cat_no, requested, message): why a release is not there, with up to three nearest ones."""
    near = nearest_releases(requests, releases).groupBy("cat_no", "requested").agg(
        F.array_sort(F.collect_list(F.struct("rank", "release_date"))).alias("near")
    )
    listed = F.array_join(F.transform("near", lambda x: x["release_date"].cast("string")), ", ")
    message = F.concat(
        F.lit("release "), F.col("requested").cast("string"),
        F.when(F.col("near").isNull(), F.lit(" is not available; no releases are known")).otherwise(
            F.concat(F.lit(" is not available; nearest known releases: "), listed)
        ),
    )
    asked = requests.select("cat_no", F.col("requested").cast("date").alias("requested")).distinct()
    return asked.join(near, ["cat_no", "requested"], "left").select("cat_no", "requested", message.alias("message"))


def nearest_releases(requests: DataFrame, releases: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` releases of a catalogue nearest to each requested date, ties earlier first.

    An as-of join without a join: days of releases and of requests are sorted together once.
    A release day carries the ``k`` days up to it and the ``k`` days after it; a request takes
    what the last release day up to it carries (the first of all, if there is none), which
    holds its ``k`` nearest. Both sides are reduced to distinct days, so the days of a
    catalogue are bounded by the calendar, and work per request does not depend on them.
    """
    days = releases.select("cat_no", F.col("release_date").cast("date").alias("day")).distinct()
    order = W.partitionBy("cat_no").orderBy("day")
    around = [F.lag("day", i).over(order) for i in range(1, k)]
    around += [F.col("day"), *(F.lead("day", i).over(order) for i in range(1, k + 1))]
    known = days.where("cat_no is not null and day is not null").select(
        "cat_no", "day", F.array_compact(F.array(*around)).alias("near"), F.lit(False).alias("asked")
    )
    asked = requests.select("cat_no", F.col("requested").cast("date").alias("day")).distinct()
    asked = asked.where("cat_no is not null and day is not null")
    both = known.unionByName(
        asked.select("cat_no", "day", F.lit(None).cast("array<date>").alias("near"), F.lit(True).alias("asked"))
    )
    # at a day that is both, the release comes first
    merged = W.partitionBy("cat_no").orderBy("day", "asked")
    before = F.last("near", ignorenulls=True).over(merged.rowsBetween(W.unboundedPreceding, 0))
    whole = merged.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    first = F.first("near", ignorenulls=True).over(whole)
    answered = both.withColumn("near", F.coalesce(before, first)).where("asked")
    ranked = F.array_sort(
        F.transform(
            "near",
            lambda d: F.named_struct(
                F.lit("days"), F.abs(F.datediff(d, F.col("day"))), F.lit("release_date"), d
            ),
        )
    )
    return answered.select(
        "cat_no", F.col("day").alias("requested"), F.posexplode(F.slice(ranked, 1, k)).alias("pos", "hit")
    ).select(
        "cat_no", "requested", (F.col("pos") + 1).alias("rank"),
        F.col("hit.release_date").alias("release_date"), F.col("hit.days").alias("days"),
    )
