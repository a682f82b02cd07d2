"""URLs, site ids and folder paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.common import as_col, py_strip, rtrim_chars
from tessera.functions.text import NO_NAME

# URL pieces as Python's ``urlsplit`` sees them: an optional scheme, an
# optional '//' authority up to the next '/', '?' or '#', then the path up to
# '?' or '#'.
_SCHEME_RE = r"^[A-Za-z][A-Za-z0-9+.-]*:"
_NETLOC_RE = r"^//([^/?#]*)"
_PATH_RE = r"^(?://[^/?#]*)?([^?#]*)"

# Fixed value: marker that separates a drive path from the item path in a
# parent reference.
ROOT_MARKER = "root:"


def normalize_url(value) -> Column:
    """trim, lower-case, drop trailing '/'; null → ''."""
    v = F.lower(py_strip(F.coalesce(as_col(value), F.lit(""))))
    return rtrim_chars(v, "/")


def _after_scheme(url: Column) -> Column:
    return F.regexp_replace(url, _SCHEME_RE, "")


def url_netloc(value) -> Column:
    return F.regexp_extract(_after_scheme(as_col(value)), _NETLOC_RE, 1)


def url_path(value) -> Column:
    return F.regexp_extract(_after_scheme(as_col(value)), _PATH_RE, 1)


def last_path_segment(value) -> Column:
    """``urlparse(url).path.rstrip('/').split('/')[-1]``."""
    path = rtrim_chars(url_path(value), "/")
    return F.regexp_extract(path, r"([^/]*)$", 1)


def display_site_name(site_name, site_url) -> Column:
    """Name unless blank or containing ',', else the last URL path segment,
    else the URL host, else the name, else '(sem nome)'."""
    name = py_strip(F.coalesce(as_col(site_name), F.lit("")))
    url = py_strip(F.coalesce(as_col(site_url), F.lit("")))
    from_url = F.coalesce(
        F.nullif(last_path_segment(url), F.lit("")),
        F.nullif(url_netloc(url), F.lit("")),
        F.nullif(name, F.lit("")),
        F.lit(NO_NAME),
    )
    return (
        F.when((name != "") & ~name.contains(","), name)
        .when(url != "", from_url)
        .otherwise(F.coalesce(F.nullif(name, F.lit("")), F.lit(NO_NAME)))
    )


def site_id_variants(value) -> Column:
    """Lower-cased whole id followed by each non-blank ','-part, distinct,
    first occurrence kept; null/blank → empty array."""
    v = F.lower(py_strip(F.coalesce(as_col(value).cast("string"), F.lit(""))))
    parts = F.filter(F.transform(F.split(v, ","), lambda p: py_strip(p)), lambda p: p != "")
    variants = F.array_distinct(F.concat(F.array(v), parts))
    return F.when(v == "", F.array().cast("array<string>")).otherwise(variants)


def full_path(parent_path, name) -> Column:
    """``rstrip(parent, '/') + '/' + name`` or just ``name`` without parent."""
    p = as_col(parent_path)
    n = as_col(name)
    return F.when(
        p.isNull() | (p == ""), n
    ).otherwise(F.concat(rtrim_chars(p, "/"), F.lit("/"), n))


def path_depth(path) -> Column:
    """Number of '/' in the path."""
    p = as_col(path)
    return F.length(p) - F.length(F.replace(p, F.lit("/"), F.lit("")))


def parent_path_from_reference(root_path, reference_path) -> Column:
    """Folder path of an item from its parent reference path:
    '' → ''; no 'root:' marker → the drive root; else the root joined with the
    text after the first marker, stripped of '/'."""
    root = as_col(root_path)
    ref = F.coalesce(as_col(reference_path), F.lit(""))
    marker_at = F.instr(ref, ROOT_MARKER)
    suffix = F.btrim(
        F.substring(ref, marker_at + F.lit(len(ROOT_MARKER)), F.lit(1 << 30)), F.lit("/")
    )
    joined = F.concat(rtrim_chars(root, "/"), F.lit("/"), suffix)
    return (
        F.when(ref == "", F.lit(""))
        .when(marker_at == 0, root)
        .when(suffix == "", root)
        .otherwise(joined)
    )
