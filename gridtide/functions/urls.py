"""URL, file name and title rules as Column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gridtide.functions.text import TABLE_NO, collapse, holds_any, let, squeeze, strip

# What a download link, and the wording around one, reads like.
DOWNLOAD_HREF = r"(?i)\.(xlsx|xls|csv)(\?|$)"
# Link labels that say nothing about the file behind them.
GENERIC_LABELS = [
    "download", "download xlsx", "download xls", "download csv", "xlsx", "xls", "csv",
]
# One of these is in each of the labels above and in all that the patterns below match.
GENERIC_WORDS = ["download", "xls", "csv"]
# Fixed values, as above.
TITLE_NOISE = (
    r"(?i)download\s*(xlsx|xls|csv)?\s*(\[[^\]]+\])?\s*(xlsx|xls|csv)?\s*(\[[^\]]+\])?"
)
TYPE_NOISE = r"(?i)\b(xlsx|xls|csv)\b\s*(\[[^\]]+\])?"

# Points of a title and of a text around a link.
TITLE_MOST, CONTEXT_MOST, TABLE_POINTS, GENERIC_TITLE, GENERIC_CONTEXT = 200, 300, 500, 1000, 500


def absolute_url(url: Column, base: Column | str) -> Column:
    base = F.lit(base) if isinstance(base, str) else base
    return let(
        strip(url),
        lambda text: F.when(text.startswith("//"), F.concat(F.lit("https:"), text))
        .when(text.startswith("/"), F.concat(base, text))
        .when(text.rlike("(?i)^https?://"), text)
        .otherwise(F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), text)),
    )


def without_query(url: Column) -> Column:
    """URL without fragment and query."""
    return F.substring_index(F.substring_index(strip(url), "#", 1), "?", 1)


def safe_filename(text: Column) -> Column:
    name = F.regexp_replace(strip(text), r"(?U)[^\w.\-]+", "_")
    single = let(
        name, lambda kept: F.when(kept.contains("__"), F.regexp_replace(kept, "_+", "_")).otherwise(kept)
    )
    trimmed = F.btrim(single, F.lit("_"))
    return let(trimmed, lambda kept: F.when(kept == "", "download").otherwise(kept))


def url_filename(url: Column) -> Column:
    name = F.substring_index(F.substring_index(url, "?", 1), "/", -1)
    return let(name, lambda last: F.when(last == "", "download").otherwise(safe_filename(last)))


def extension(name: Column) -> Column:
    """Last dot and what follows it, or an empty text."""

    def after(name: Column) -> Column:
        last = F.concat(F.lit("."), F.substring_index(name, ".", -1))
        return F.when(~name.contains("."), "").otherwise(last)

    return let(name, after)


def stem(name: Column) -> Column:
    """What comes before the extension."""

    def before(name: Column) -> Column:
        length = F.length(name) - F.length(F.substring_index(name, ".", -1)) - 1
        return F.when(name.contains("."), F.left(name, length)).otherwise(name)

    return let(name, before)


def title_from_filename(url: Column) -> Column:
    text = F.regexp_replace(stem(url_filename(url)), "^[0-9]+[A-Za-z]*_?", "")
    return strip(squeeze(F.regexp_replace(text, "[_-]+", " ")))


def looks_like_cube(label: Column, url: Column) -> Column:
    return F.lower(F.concat_ws(" ", label, url)).contains("cube")


def file_type(url: Column, label: Column, name: Column | None = None) -> Column:
    """``name`` is the :func:`url_filename`, here and below, where it is there already."""
    name = url_filename(url) if name is None else name
    return let(
        F.lower(F.ltrim(extension(name), F.lit("."))),
        lambda ext: F.when(ext != "", ext).when(looks_like_cube(label, url), "cube").otherwise("unknown"),
    )


def indexed_filename(
    cat_no: Column, url: Column, title: Column, name: Column | None = None
) -> Column:

    def indexed(name: Column) -> Column:
        base = F.when(strip(title) == "", stem(name)).otherwise(safe_filename(title))
        return F.concat(safe_filename(F.concat_ws("_", cat_no, base)), extension(name))

    return let(url_filename(url) if name is None else name, indexed)


def table_no_from_filename(cat_no: Column, url: Column, name: Column | None = None) -> Column:
    """Table number that follows the catalogue digits in names like ``62020001.xlsx``."""

    def numbered(found: Column) -> Column:
        number = F.regexp_extract(found, "^([0-9]+)", 1).try_cast("int").cast("string")
        suffix = F.regexp_extract(found, "([a-z]?)$", 1)
        return F.when(found != "", F.concat(number, suffix))

    def after(both: Column) -> Column:
        name, digits = both["name"], both["digits"]
        rest = F.substr(name, F.length(digits) + F.lit(1))
        found = F.regexp_extract(rest, "^0*([0-9]{1,3}[a-z]?)", 1)
        return F.when(name.startswith(digits), let(found, numbered))

    name = F.lower(stem(url_filename(url) if name is None else name))
    digits = F.regexp_replace(cat_no, "[^0-9]", "")
    return let(F.named_struct(F.lit("name"), name, F.lit("digits"), digits), after)


def _is_generic(clean: Column) -> Column:
    """:func:`is_generic_label` of a text that is collapsed already."""

    def generic(text: Column) -> Column:
        bare = F.trim(squeeze(F.regexp_replace(text, r"\[[^\]]+\]", "")))
        # Only a text with one of these words can be generic; most are decided here.
        return (text == "") | (holds_any(text, GENERIC_WORDS) & bare.isin(GENERIC_LABELS))

    return let(F.lower(clean), generic)


def is_generic_label(label: Column) -> Column:
    return _is_generic(collapse(label))


def _context_title(clean: Column, label: Column) -> Column:
    text = F.when(label != "", F.replace(clean, label, F.lit(" "))).otherwise(clean)

    def plain(text: Column) -> Column:
        title = F.regexp_replace(F.regexp_replace(text, TITLE_NOISE, " "), TYPE_NOISE, " ")
        return F.when(holds_any(F.lower(text), GENERIC_WORDS), title).otherwise(text)

    return F.btrim(squeeze(let(text, plain)), F.lit(" -|:"))


def context_title(context: Column, label: Column) -> Column:
    """Text around a link without the link label and the download wording."""
    return _context_title(collapse(context), label)


def context_score(plain: Column) -> Column:
    """Points of a collapsed text around a link."""
    score = (
        F.greatest(F.lit(0), F.lit(CONTEXT_MOST) - F.length(plain))
        + F.when(plain.rlike(TABLE_NO), TABLE_POINTS).otherwise(0)
        - F.when(_is_generic(plain), GENERIC_CONTEXT).otherwise(0)
    )
    return F.when(plain == "", 0).otherwise(score)


def title_score(text: Column) -> Column:

    def scored(plain: Column) -> Column:
        score = (
            F.least(F.length(plain), F.lit(TITLE_MOST))
            + F.when(plain.rlike(TABLE_NO), TABLE_POINTS).otherwise(0)
            - F.when(_is_generic(plain), GENERIC_TITLE).otherwise(0)
        )
        return F.when(plain == "", 0).otherwise(score)

    return let(collapse(text), scored)


def file_title(label: Column, context: Column, url: Column) -> Column:
    """Best title of a file: its link label, else the text around it, else its name.

    ``label`` and ``context`` are collapsed texts.
    """

    def from_name(title: Column) -> Column:
        return F.when(title != "", title).otherwise(url_filename(url))

    def from_text(around: Column) -> Column:
        return F.when(~_is_generic(around), around).otherwise(let(title_from_filename(url), from_name))

    return F.when(~_is_generic(label), label).otherwise(let(_context_title(context, label), from_text))


def table_title(title: Column, context: Column) -> Column:
    """Text around the link when it names a table, else the file title."""
    return let(
        _context_title(context, F.lit("")),
        lambda around: F.when(around.rlike(TABLE_NO) & ~_is_generic(around), around).otherwise(title),
    )
