"""SDMX-JSON documents: observations, dimensions and codes, filter keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from gridtide.functions.numbers import text_number
from gridtide.functions.periods import text_period
from gridtide.functions.text import filter_key, strip
from gridtide.operators.series import period_range
from gridtide.schemas import DATASTRUCTURE
from gridtide.staging import stage

# Reasons that an error lists before it only says how many there are.
ERRORS = 20
_VALUES = "array<struct<id:string>>"
_DIMS = f"array<struct<id:string,values:{_VALUES}>>"
_OBSERVATIONS = "map<string,array<string>>"
_SERIES_ENTRIES = f"array<struct<key:string,value:struct<observations:{_OBSERVATIONS}>>>"
DATA_SCHEMA = (
    f"struct<structure:struct<dimensions:struct<series:{_DIMS},observation:{_DIMS}>>,"
    f"dataSets:array<struct<series:map<string,struct<observations:{_OBSERVATIONS}>>,"
    f"observations:{_OBSERVATIONS}>>>"
)


def _resolve(dims: Column, key: Column) -> Column:
    """Entries (dimension id, code) of a positional key such as ``0:3:1``.

    Indexes are 0-based; one that is no integer or out of range leaves no entry.
    """
    indexes = F.split(key, ":")

    def entry(dim: Column, position: Column) -> Column:
        index = F.get(indexes, position).try_cast("int")
        code = F.when(index >= 0, F.get(dim["values"], index)["id"])
        return F.named_struct(F.lit("id"), dim["id"], F.lit("code"), code)

    resolved = F.transform(F.coalesce(dims, F.array().cast(_DIMS)), entry)
    return F.filter(resolved, lambda e: e["code"].isNotNull() & e["id"].isNotNull())


def _merged(first: Column, second: Column) -> Column:
    """Both entry lists as a map; a repeated dimension takes its last code."""
    entries = F.concat(first, second)
    ids = F.transform(entries, lambda e: e["id"])
    unique = F.size(F.array_distinct(ids)) == F.size(ids)
    last = F.filter(
        F.transform(
            entries,
            lambda e, i: F.named_struct(
                F.lit("id"), e["id"], F.lit("code"), e["code"], F.lit("at"), i
            ),
        ),
        lambda e: ~F.exists(
            F.slice(entries, e["at"] + 2, F.size(entries)), lambda later: later["id"] == e["id"]
        ),
    )
    kept = F.map_from_entries(F.transform(last, lambda e: F.struct(e["id"], e["code"])))
    return F.when(unique, F.map_from_entries(entries)).otherwise(kept)


def observations(documents: DataFrame, json: str = "json") -> DataFrame:
    """One row per observation: the document's other columns, period, date, value, dims.

    Series-level and flat observations are both read. The value is the first element of
    an observation, the period its ``TIME_PERIOD`` or ``time`` code, else its key.
    """
    keys = [name for name in documents.columns if name != json]
    parsed = documents.select(*keys, F.from_json(json, DATA_SCHEMA).alias("doc"))
    sets = parsed.select(
        *keys, "doc.structure.dimensions.*", F.explode("doc.dataSets").alias("set")
    )
    # Flat observations are read as those of one more series, with an empty key.
    flat = F.array(
        F.named_struct(
            F.lit("key"), F.lit(""),
            F.lit("value"), F.named_struct(F.lit("observations"), F.col("set.observations")),
        )
    )
    listed = F.coalesce(F.map_entries("set.series"), F.array().cast(_SERIES_ENTRIES))
    by_series = sets.select(
        *keys, "series", "observation", F.explode(F.concat(listed, flat)).alias("one")
    ).select(
        *keys, "observation",
        _resolve(F.col("series"), F.col("one.key")).alias("series_codes"),
        F.explode("one.value.observations").alias("obs_key", "obs"),
    )
    rows = by_series.select(
        *keys, "obs_key", "series_codes",
        _resolve(F.col("observation"), F.col("obs_key")).alias("obs_codes"),
        text_number(F.get("obs", F.lit(0))).alias("value"),
    )

    def code_of(name: str) -> Column:
        return F.get(F.filter("obs_codes", lambda e: e["id"] == name), F.lit(0))["code"]

    period = F.coalesce(code_of("TIME_PERIOD"), code_of("time"), "obs_key")
    dated = rows.withColumn("period", period)
    return dated.select(
        *keys, "period", text_period("period")["date"].alias("date"), "value",
        _merged(F.col("series_codes"), F.col("obs_codes")).alias("dims"),
    )


# ---------------------------------------------------------------- trees


def _descend(level: DataFrame, names: Sequence[str]) -> DataFrame:
    """One level down: nodes already found pass through, others give way to their children."""
    done = F.col("done")
    children = level.withColumn("open", F.when(~done, F.col("node"))).lateralJoin(
        level.sparkSession.tvf.variant_explode_outer(F.col("open").outer())
    )
    is_named = F.coalesce(F.col("key").isin(list(names)), F.lit(False))
    return children.where(done | F.col("pos").isNotNull()).select(
        "doc_id",
        F.when(done, F.col("node")).otherwise(F.col("value")).alias("node"),
        F.when(done, F.col("path")).otherwise(F.concat("path", F.array("pos"))).alias("path"),
        (done | is_named).alias("done"),
    )


def collect_named(documents: DataFrame, names: Sequence[str], step: int = 8) -> DataFrame:
    """Everything found under one of the given keys, at any nesting level.

    ``documents`` has a key column ``doc_id`` and a variant column ``tree``. Arrays and
    objects under such a key give one row per member, other values one row; the search
    does not go on inside them. ``path`` lists the positions leading to the row. The search
    goes ``step`` levels at a time, and on only with the nodes still open after that.
    """
    level = documents.select(
        "doc_id", F.col("tree").alias("node"), F.array().cast("array<int>").alias("path"),
        F.lit(False).alias("done"),
    )
    heads = []
    while True:
        for _ in range(step):
            level = _descend(level, names)
        level = stage(level, "tree-levels")  # Parquet holds variants as they are
        heads.append(level.where("done").select("doc_id", "node", "path"))
        level = level.where("not done")
        if level.isEmpty():
            break
    found = reduce(DataFrame.unionByName, heads)
    nested = found.lateralJoin(
        found.sparkSession.tvf.variant_explode_outer(F.col("node").outer())
    )
    return nested.select(
        "doc_id",
        F.coalesce("value", "node").alias("node"),
        F.concat("path", F.array(F.coalesce("pos", F.lit(0)))).alias("path"),
    )


def _text(node: Column, path: str) -> Column:
    return F.try_variant_get(node, path, "string")


def _localised(node: Column, field: str) -> Column:
    """A plain text, or the English entry of an object of texts."""
    plain = _text(node, f"$.{field}")
    is_object = F.coalesce(plain.startswith("{"), F.lit(False))
    english = F.coalesce(_text(node, f"$.{field}.en"), F.lit(""))
    return F.when(is_object, english).otherwise(F.coalesce(plain, F.lit("")))


def _with_tree(documents: DataFrame, json: str) -> DataFrame:
    return documents.select("doc_id", F.try_parse_json(json).alias("tree"))


def dataflows(documents: DataFrame, json: str = "json") -> DataFrame:
    """Flows named in the documents: id, name, description; those without id are skipped."""
    flows = collect_named(_with_tree(documents, json), ["dataflows", "Dataflows"])
    node = F.col("node")
    rows = flows.select(
        _text(node, "$.id").alias("id"),
        _localised(node, "name").alias("name"),
        _localised(node, "description").alias("description"),
    )
    return rows.where(F.coalesce("id", F.lit("")) != "").distinct()


# Where dimensions are listed, all of them read, in this order.
_DIMENSION_PATHS = [
    "$.data.dataStructures[0].dataStructureComponents.dimensionList.dimensions",
    "$.dataStructures[0].dataStructureComponents.dimensionList.dimensions",
    "$.structure.dimensions.series",
    "$.structure.dimensions.observation",
]


def _dimensions(trees: DataFrame) -> DataFrame:
    none = F.array().cast("array<variant>")
    lists = [
        F.coalesce(F.try_variant_get("tree", path, "array<variant>"), none)
        for path in _DIMENSION_PATHS
    ]
    listed = trees.withColumn("listed", F.concat(*lists))
    known = listed.where(F.size("listed") > 0).select(
        "doc_id", F.posexplode("listed").alias("ord", "node")
    )
    other = listed.where(F.size("listed") == 0)
    searched = collect_named(other, ["dimensions", "Dimensions"])
    in_order = W.partitionBy("doc_id").orderBy("path")
    searched = searched.select(
        "doc_id", (F.row_number().over(in_order) - 1).alias("ord"), "node"
    )
    rows = known.unionByName(searched).withColumn("dimension_id", _text(F.col("node"), "$.id"))
    return rows.where(F.coalesce("dimension_id", F.lit("")) != "")


def _codelists(trees: DataFrame) -> DataFrame:
    """Code lists by id; the last one of an id counts."""
    found = collect_named(trees, ["codelists", "Codelists"])
    found = found.withColumn("codelist_id", _text(F.col("node"), "$.id"))
    none = F.array().cast("array<variant>")

    def codes(field: str) -> Column:
        return F.coalesce(F.try_variant_get("node", f"$.{field}", "array<variant>"), none)

    lists = F.when(F.size(codes("items")) > 0, codes("items")).otherwise(codes("codes"))
    last = F.row_number().over(
        W.partitionBy("doc_id", "codelist_id").orderBy(F.col("path").desc())
    )
    return (
        found.where(F.coalesce("codelist_id", F.lit("")) != "")
        .withColumn("last", last)
        .where("last = 1")
        .select("doc_id", "codelist_id", lists.alias("listed_codes"))
    )


def datastructure(documents: DataFrame, json: str = "json") -> DataFrame:
    """Dimensions x codes of each document (``doc_id`` and a JSON text).

    Codes written inside a dimension win over the code list it refers to; a dimension
    without codes gives one row with a null code.
    """
    trees = _with_tree(documents, json)
    node = F.col("node")
    dims = _dimensions(trees)
    first_seen = W.partitionBy("doc_id").orderBy("ord")
    new = F.row_number().over(W.partitionBy("doc_id", "dimension_id").orderBy("ord")) == 1
    dims = dims.withColumn("new", new.cast("int"))
    seen_before = F.coalesce(
        F.sum("new").over(first_seen.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    given = _text(node, "$.position").try_cast("int") + 1
    reference = [
        F.when(_text(node, f"$.localRepresentation.enumeration.{f}") != "",
               _text(node, f"$.localRepresentation.enumeration.{f}"))
        for f in ("id", "ref")
    ]
    none = F.array().cast("array<variant>")
    dims = dims.select(
        "doc_id", "dimension_id",
        _localised(node, "name").alias("dimension_name"),
        F.coalesce(given, seen_before + 1).cast("int").alias("position"),
        F.coalesce(*reference).alias("codelist_id"),
        F.coalesce(F.try_variant_get("node", "$.values", "array<variant>"), none).alias("inline"),
    )
    joined = dims.join(_codelists(trees), ["doc_id", "codelist_id"], "left")
    codes = F.when(F.size("inline") > 0, F.col("inline")).otherwise(F.col("listed_codes"))
    rows = joined.select(
        "doc_id", "dimension_id", "dimension_name", "position",
        F.posexplode_outer(codes).alias("pos", "code_node"),
    )
    code = F.col("code_node")
    has_code = F.col("pos").isNotNull()
    label = _localised(code, "name")
    return rows.select(
        "doc_id", "dimension_id", "dimension_name", "position",
        F.when(has_code, F.coalesce(_text(code, "$.id"), F.lit(""))).alias("code"),
        F.when(has_code & (label != ""), label).alias("label"),
        (F.col("pos") + 1).alias("code_position"),
    ).select("doc_id", *DATASTRUCTURE).distinct()


def ordered_structure(structure: DataFrame) -> DataFrame:
    """Rows by position, then code position, dimensions without codes last."""
    return structure.orderBy("position", F.col("code_position").asc_nulls_last())


# ---------------------------------------------------------------- filters and keys


def _name_keys(structure: DataFrame) -> DataFrame:
    """Dimension of each normalised name or id; the first position wins."""
    dims = structure.select("doc_id", "dimension_id", "dimension_name", "position").distinct()
    keys = F.array(filter_key(F.col("dimension_id")), filter_key(F.col("dimension_name")))
    first = F.min(F.struct("position", "dimension_id"))["dimension_id"]
    return (
        dims.withColumn("name_key", F.explode(keys))
        .groupBy("doc_id", "name_key")
        .agg(first.alias("dimension_id"))
    )


def _code_keys(structure: DataFrame) -> DataFrame:
    """Code of each lower-cased code or normalised label; the first position wins."""
    codes = structure.where(F.col("code").isNotNull())
    probes = F.array_compact(
        F.array(
            F.concat(F.lit("code:"), F.lower("code")),
            F.concat(F.lit("label:"), filter_key(F.col("label"))),
        )
    )
    first = F.min(F.struct("code_position", "code"))
    return (
        codes.withColumn("probe", F.explode(probes))
        .groupBy("doc_id", "dimension_id", "probe")
        .agg(first.alias("hit"))
    )


def resolve_filters(structure: DataFrame, requests: DataFrame) -> DataFrame:
    """Dimension and code meant by each requested (name, code), errors as a column.

    ``requests`` has ``request_id, doc_id, ord, name, code_ord, code``. A later filter on
    the same dimension replaces an earlier one.
    """
    named = requests.withColumn("name_key", filter_key(F.col("name"))).join(
        _name_keys(structure), ["doc_id", "name_key"], "left"
    )
    last = F.max("ord").over(W.partitionBy("request_id", "doc_id", "dimension_id"))
    kept = named.withColumn("last_ord", last).where(
        (F.col("ord") == F.col("last_ord")) | F.col("dimension_id").isNull()
    )
    wanted = strip(F.col("code").cast("string"))
    probes = F.array(
        F.concat(F.lit("code:"), F.lower(wanted)), F.concat(F.lit("label:"), filter_key(wanted))
    )
    row = ["request_id", "doc_id", "ord", "name", "code_ord", "code", "dimension_id"]
    probed = kept.select(*row, F.explode(probes).alias("probe")).join(
        _code_keys(structure), ["doc_id", "dimension_id", "probe"], "left"
    )
    best = probed.groupBy(*row).agg(F.min("hit")["code"].alias("matched"))
    coded = structure.where(F.col("code").isNotNull()).select("doc_id", "dimension_id").distinct()
    coded = coded.withColumn("has_codes", F.lit(True))
    resolved = best.join(coded, ["doc_id", "dimension_id"], "left")
    free = (wanted == "") | F.col("has_codes").isNull()
    value = F.when(free, wanted).otherwise(F.col("matched"))
    error = F.when(
        F.col("dimension_id").isNull(), F.concat(F.lit("unknown filter "), F.col("name"))
    ).when(
        value.isNull(),
        F.concat(F.lit("invalid code "), wanted, F.lit(" for dimension "), F.col("dimension_id")),
    )
    return resolved.select(
        "request_id", "doc_id", "name", "dimension_id", "code_ord",
        F.when(F.col("dimension_id").isNotNull(), value).alias("code"), error.alias("error"),
    )


def code_examples(structure: DataFrame, k: int = 8) -> DataFrame:
    """First ``k`` codes of each dimension, for messages about invalid ones."""
    order = W.partitionBy("doc_id", "dimension_id").orderBy("code_position")
    ranked = structure.where(F.col("code").isNotNull()).withColumn(
        "rank", F.row_number().over(order)
    )
    return ranked.where(F.col("rank") <= k).select("doc_id", "dimension_id", "rank", "code")


def api_keys(structure: DataFrame, requests: DataFrame) -> DataFrame:
    """Key of each request: dimensions by position joined by ``.``, codes by ``+``.

    ``requests`` as in :func:`resolve_filters`; a request whose ``name`` is null has no
    filters and gets the key "all". One row per request with ``key`` or ``error``.
    """
    resolved = resolve_filters(structure, requests.where(F.col("name").isNotNull()))
    codes = F.transform(
        F.array_sort(F.collect_list(F.struct("code_ord", "code"))), lambda c: c["code"]
    )
    segments = (
        resolved.groupBy("request_id", "doc_id", "dimension_id")
        .agg(F.array_join(codes, "+").alias("segment"), F.min("error").alias("error"))
        .groupBy("request_id", "doc_id")
        .agg(
            F.map_from_entries(
                F.collect_list(
                    F.when(F.col("dimension_id").isNotNull(), F.struct("dimension_id", "segment"))
                )
            ).alias("segments"),
            F.min("error").alias("error"),
        )
    )
    dims = structure.select("doc_id", "position", "dimension_id").distinct()
    ordered = dims.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "dimension_id"))).alias("dims")
    )
    filled = segments.join(ordered, "doc_id")
    key = F.array_join(
        F.transform(
            "dims",
            lambda d: F.coalesce(F.try_element_at("segments", d["dimension_id"]), F.lit("")),
        ),
        ".",
    )
    open_requests = requests.where(F.col("name").isNull()).select(
        "request_id", "doc_id", F.lit("all").alias("key"), F.lit(None).cast("string").alias("error")
    )
    return filled.select(
        "request_id", "doc_id", F.when(F.col("error").isNull(), key).alias("key"), "error"
    ).unionByName(open_requests.distinct())


def _documents(structure: DataFrame) -> list:
    """Up to two of the documents in a structure: enough to see whether there is one."""
    return [row[0] for row in structure.select("doc_id").distinct().limit(2).collect()]


def api_key(structure: DataFrame, filters: Mapping[str, object] | None = None) -> str:
    """Key of one set of typed filters; raises on unknown names and codes, and if the
    structure holds several documents."""
    if filters is not None and not isinstance(filters, Mapping):
        raise ValueError("filters must be a mapping of names to codes")
    if len(_documents(structure)) > 1:
        raise ValueError("the structure holds several documents; choose one")
    row = api_keys(structure, _typed_requests(structure, filters or {})).first()
    if row is None:
        raise ValueError("the data structure has no dimensions; give an explicit key")
    if row["error"]:
        raise ValueError(row["error"])
    return row["key"]


def _typed_requests(structure: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    """The typed filters, once for each document of the structure."""
    rows = []
    for ord_, (name, value) in enumerate(filters.items()):
        codes = list(value) if isinstance(value, (list, tuple, set)) else [value]
        rows += [(ord_, name, i, str(code)) for i, code in enumerate(codes or [""])]
    if not rows:
        rows = [(0, None, 0, "")]
    typed = F.array(
        *(
            F.struct(
                F.lit(ord_).alias("ord"), F.lit(name).cast("string").alias("name"),
                F.lit(i).alias("code_ord"), F.lit(code).alias("code"),
            )
            for ord_, name, i, code in rows
        )
    )
    return structure.select("doc_id").distinct().select(
        F.lit(1).alias("request_id"), "doc_id", F.inline(typed)
    )


def filter_observations(
    df: DataFrame,
    structure: DataFrame,
    filters: Mapping[str, object],
    start_period: str | None = None,
    end_period: str | None = None,
) -> DataFrame:
    """Observations that meet typed filters on dimension names, labels or codes.

    Filters are resolved in each document of ``structure`` and applied to the observations
    of that document (column ``doc_id`` of both); observations of documents without a
    structure don't pass. Without ``doc_id`` in ``df``, the structure must hold one document.
    """
    if filters:
        resolved = stage(resolve_filters(structure, _typed_requests(structure, filters)), "filters")
        wrong = resolved.where(F.col("error").isNotNull()).select("error").distinct()
        errors = [row["error"] for row in wrong.orderBy("error").limit(ERRORS).collect()]
        if errors:
            more = wrong.count() - len(errors)
            raise ValueError("; ".join(errors) + (f"; and {more} more" if more else ""))
        # one short row for each document: at most the codes that were typed
        by_dimension = resolved.groupBy("doc_id", "dimension_id").agg(
            F.collect_set(F.when(F.col("code") != "", F.col("code"))).alias("codes")
        )
        allowed = by_dimension.groupBy("doc_id").agg(
            F.collect_list(F.struct("dimension_id", "codes")).alias("allowed")
        )
        if "doc_id" in df.columns:
            joined = df.join(allowed, "doc_id")
        else:
            if len(_documents(structure)) > 1:
                raise ValueError("observations of several documents need a column doc_id")
            row = allowed.first()
            entries = [] if row is None else row["allowed"]
            joined = df.withColumn("allowed", F.array(
                *(
                    F.struct(
                        F.lit(entry["dimension_id"]).alias("dimension_id"),
                        F.array(*map(F.lit, sorted(entry["codes"]))).cast("array<string>").alias("codes"),
                    )
                    for entry in entries
                )
            ))
        fits = F.forall(
            "allowed",
            lambda one: (F.size(one["codes"]) == 0) | F.coalesce(
                F.array_contains(one["codes"], F.try_element_at("dims", one["dimension_id"])),
                F.lit(False),
            ),
        )
        df = joined.where(fits).select(*df.columns)
    return period_range(df, start_period, end_period)
