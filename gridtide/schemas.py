"""Fixed schemas and the fixed label, family and column tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "BIGINT": T.LongType(),
    "DATE": T.DateType(),
    "BOOLEAN": T.BooleanType(),
}


def _struct(fields: str) -> T.StructType:
    """Schema from ``name TYPE, ...``; unlike the DDL parser it needs no session."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])

# A sheet is one (file, sheet number); ordinals are 1-based inside the used range.
SHEET = ["source_file", "sheet_no"]

CELLS = _struct(
    "source_file STRING, sheet_no INT, sheet STRING, row_no BIGINT, col_no INT, "
    "kind STRING, text STRING, num DOUBLE, date DATE"
)

# Names of the columns of observations, series, cubes and index tables.
OBS = [
    "cat_no", "release_date", "table", "table_no", "table_title", "sheet", "sheet_no",
    "date", "series_id", "value", "unit", "series_type", "data_type", "frequency",
    "collection_month", "series_start", "series",
]
SERIES_META = [name for name in OBS if name not in ("date", "value")] + ["source_workbook"]
CUBE = [
    "source_file", "cat_no", "release_date", "cube", "cube_title", "sheet", "date",
    "frequency", "value",
]

FILE_INDEX = _struct(
    "cat_no STRING, title STRING, description STRING, page_url STRING, release_date STRING, "
    "file_title STRING, url STRING, filename STRING, file_type STRING, table_no STRING, "
    "table_title STRING, is_timeseries BOOLEAN, is_cube BOOLEAN"
)
RELEASES = _struct(
    "cat_no STRING, title STRING, release_date DATE, release_url STRING"
)
CATALOGUES = ["cat_no", "title", "description", "page_url", "supported"]
DATASTRUCTURE = [
    "dimension_id", "dimension_name", "position", "code", "label", "code_position",
]

# Role of a label cell -> accepted keys, best first.
LABELS = {
    "series_id": ["seriesid", "seriesnumber"],
    "series": ["dataitem", "series", "seriesdescription", "description", "title"],
    "unit": ["unit", "units", "unitofmeasure"],
    "frequency": ["frequency", "freq"],
    "series_type": [
        "seriestype", "seasonaladjustment", "seasonaladjustmenttype", "adjustment",
    ],
    "data_type": ["datatype"],
    "collection_month": ["collectionmonth", "collection"],
    "series_start": ["seriesstart", "startdate", "start"],
}
# Roles that become attribute columns next to the identifier.
ATTRIBUTES = [role for role in LABELS if role != "series_id"]

# Keys of the cells that announce catalogue number and release.
CATALOGUE_KEYS = ["cataloguenumber", "catalogueno", "catno", "catnumber"]
RELEASE_KEYS = ["releasedate", "released", "publicationdate", "referenceperiod"]

# Family -> catalogue number, kind of file, default file selector.
FAMILIES = {
    "cpi": ("6401.0", "timeseries", None),
    "awe": ("6302.0", "timeseries", None),
    "erp": ("3101.0", "timeseries", None),
    "job_mobility": ("6226.0", "timeseries", None),
    "payrolls": ("6160.0.55.001", "timeseries", None),
    "lfs_grossflows": ("6202.0", "cube", "gross flows"),
    "lfs_cube": ("6202.0", "cube", None),
}
