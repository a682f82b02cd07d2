"""File attributes: extension, category, usage status, dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.common import as_col, ltrim_chars, py_strip

# Extension sets of the five named categories, in natural order.
OFFICE_EXTENSIONS = [
    "doc", "docm", "docx", "dot", "dotm", "dotx", "odp", "ods", "odt", "one",
    "pdf", "pot", "potm", "potx", "pps", "ppsm", "ppsx", "ppt", "pptm", "pptx",
    "rtf", "xls", "xlsb", "xlsm", "xlsx",
]
IMAGE_EXTENSIONS = [
    "ai", "bmp", "gif", "heic", "heif", "ico", "jpeg", "jpg", "png", "psd",
    "svg", "tif", "tiff", "webp",
]
VIDEO_EXTENSIONS = ["avi", "flv", "m4v", "mkv", "mov", "mp4", "mpeg", "mpg", "ts", "webm", "wmv"]
ARCHIVE_EXTENSIONS = ["7z", "bz2", "gz", "rar", "tar", "tgz", "xz", "zip"]
EXECUTABLE_EXTENSIONS = ["app", "bat", "bin", "cmd", "com", "dll", "dmg", "exe", "msi", "ps1", "sh"]

# Category labels, checked in this order; anything else is "Other".
EXTENSION_CATEGORIES = [
    ("Office Documents", OFFICE_EXTENSIONS),
    ("Images", IMAGE_EXTENSIONS),
    ("Videos", VIDEO_EXTENSIONS),
    ("Archives", ARCHIVE_EXTENSIONS),
    ("Executables", EXECUTABLE_EXTENSIONS),
]
OTHER_CATEGORY = "Other"

# Usage-status thresholds in days since last modification.
ACTIVE_MAX_DAYS = 90
LOW_USAGE_MAX_DAYS = 180
UNUSED_MAX_DAYS = 365
# Usage-status labels.
USAGE_ACTIVE = "Active"
USAGE_LOW = "Low Usage"
USAGE_UNUSED = "Unused"
USAGE_ARCHIVE = "Archive Candidate"
USAGE_UNKNOWN = "Unknown"

# A suffix is the text after the last '.', provided something precedes that
# dot and something follows it ('.bashrc' and 'a.' have none).
_SUFFIX_RE = r"(?s)^.+\.([^.]+)$"


def extension_from_name(name, item_type=None) -> Column:
    """Lower-cased suffix without the dot; null when there is none or when the
    item is not a file."""
    n = F.coalesce(as_col(name), F.lit(""))
    ext = F.lower(F.regexp_extract(n, _SUFFIX_RE, 1))
    ext = F.when(ext == "", F.lit(None).cast("string")).otherwise(ext)
    if item_type is None:
        return ext
    return F.when(as_col(item_type) == "file", ext).otherwise(F.lit(None).cast("string"))


def normalize_extension(value) -> Column:
    """null → '', lower, strip whitespace, strip every leading '.'."""
    v = F.lower(F.coalesce(as_col(value).cast("string"), F.lit("")))
    return ltrim_chars(py_strip(v), ".")


def extension_category(value) -> Column:
    """Category of an (un-normalised) extension."""
    ext = normalize_extension(value)
    expr = None
    for label, members in EXTENSION_CATEGORIES:
        cond = ext.isin(members)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(OTHER_CATEGORY))


def parse_timestamp(value) -> Column:
    """ISO-8601 text → timestamp (UTC session); '' and garbage → null."""
    return as_col(value).cast("string").try_cast("timestamp")


def days_since(ts, as_of) -> Column:
    """Whole days between midnight of ``as_of`` and midnight of ``ts``."""
    return F.datediff(as_col(as_of), F.to_date(as_col(ts)))


def usage_status(days) -> Column:
    d = as_col(days)
    return (
        F.when(d.isNull(), F.lit(USAGE_UNKNOWN))
        .when(d <= ACTIVE_MAX_DAYS, F.lit(USAGE_ACTIVE))
        .when(d <= LOW_USAGE_MAX_DAYS, F.lit(USAGE_LOW))
        .when(d <= UNUSED_MAX_DAYS, F.lit(USAGE_UNUSED))
        .otherwise(F.lit(USAGE_ARCHIVE))
    )


def iso_utc(ts) -> Column:
    """Timestamp → ``YYYY-MM-DDTHH:MM:SSZ`` text (the catalogue's format)."""
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")
