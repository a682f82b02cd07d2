"""Column expressions for the inventory engine.

Every function returns a ``pyspark.sql.Column`` built from Spark built-ins,
so it stays inside whole-stage codegen; there are no Python UDFs.
"""

from tessera.functions.classify import (  # noqa: F401
    activity_class,
    audit_ratio,
    audit_status,
    is_blocked,
    is_retryable,
    limit_class,
    quota_percent,
    run_outcome,
    storage_tier,
    version_percent,
)
from tessera.functions.common import as_col, blank_to_null, py_strip  # noqa: F401
from tessera.functions.files import (  # noqa: F401
    days_since,
    extension_category,
    extension_from_name,
    iso_utc,
    normalize_extension,
    parse_timestamp,
    usage_status,
)
from tessera.functions.sizes import (  # noqa: F401
    bytes_to,
    format_count,
    format_gb,
    format_size,
    mb_to_bytes,
    percent_of,
    round_ratio,
    rounded_units,
    wide_sum,
)
from tessera.functions.text import (  # noqa: F401
    clean_text,
    is_true_text,
    is_truthy,
    label_or_default,
    report_int,
    shorten_label,
    to_int_or_null,
    to_long_or_zero,
    truncate_message,
)
from tessera.functions.urls import (  # noqa: F401
    display_site_name,
    full_path,
    last_path_segment,
    normalize_url,
    parent_path_from_reference,
    path_depth,
    site_id_variants,
    url_netloc,
    url_path,
)
