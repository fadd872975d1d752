"""Scalar column functions (built-in Spark expressions only)."""

from lanekit.functions.columns import (  # noqa: F401
    SITE_SUFFIX_TOKENS,
    clean_line,
    first_token,
    literal_split,
    prorated,
    rewrite_text,
    route_segments,
    safe_ratio,
    segment_fields,
    split_at,
    stop_pattern,
    strip_tokens,
)
