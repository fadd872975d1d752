"""Column -> Column helpers. All are built-in Spark expressions, so they stay
inside whole-stage code generation and are usable from SQL steps through the
equivalent built-in functions."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Site-type suffix tokens removed from site and location names
# before names are compared (distribution centre, collection centre,
# collection station, collection-and-delivery station), in this order.
SITE_SUFFIX_TOKENS = ("分拨中心", "集散中心", "集散站", "集配站")

# Separators inside a route segment value
# ``mode*from-to*factor*ordinal`` and between stops of a schedule.
SEGMENT_FIELD_SEP = "*"
STOP_SEP = "-"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_split(c, sep: str) -> Column:
    """``split`` on a literal separator (Spark's split takes a regex; the
    separator is quoted so ``*`` or ``-`` mean themselves). A single character,
    escaped where it has a meaning, is split at without a regex for every row."""
    if len(sep) == 1:
        return F.split(_col(c), "\\" + sep if sep in ".$|()[{^?*+\\" else sep)
    return F.split(_col(c), "\\Q" + sep + "\\E")


def strip_tokens(c, tokens: Sequence[str] = SITE_SUFFIX_TOKENS) -> Column:
    """Remove every literal token, applied in the given order."""
    return reduce(lambda acc, tok: F.replace(acc, F.lit(tok), F.lit("")), tokens, _col(c))


def split_at(c, sep: str, index: int) -> Column:
    """0-based element of a literal split; null when the index is past the
    end (ANSI-safe ``get`` instead of ``[]``)."""
    return F.get(literal_split(c, sep), index)


def safe_ratio(num, den) -> Column:
    """``num / den`` that is null on a zero or null divisor."""
    return F.try_divide(_col(num), _col(den))


def prorated(weight, pieces, qty) -> Column:
    """Share of ``weight`` carried by ``qty`` of ``pieces``; null when the
    divisor is zero or missing, so ``sum`` skips it."""
    return safe_ratio(F.coalesce(_col(weight), F.lit(0)), F.coalesce(_col(pieces), F.lit(0))) \
        * F.coalesce(_col(qty), F.lit(0))


def rewrite_text(c, rules: Iterable[tuple[str, str]]) -> Column:
    """Apply literal ``(old, new)`` replacement rules once each, in order."""
    return reduce(lambda acc, r: F.replace(acc, F.lit(r[0]), F.lit(r[1])), rules, _col(c))


# The characters that trimming a line removes, U+0000 to U+0020.
TRIMMED = "".join(map(chr, range(0x21)))


def trim_line(c) -> Column:
    """Without leading and trailing control characters and blanks."""
    return F.btrim(_col(c), F.lit(TRIMMED))


def first_token(c) -> Column:
    """First whitespace-separated token of a trimmed string ('' for blank)."""
    return F.get(F.split(trim_line(c), "\\s+"), 0)


def clean_line(c) -> Column:
    """Trimmed, lower-cased line with quote characters removed."""
    return F.lower(trim_line(F.translate(_col(c), "`'\"", "")))


def stop_pattern(stops: Column) -> Column:
    """Letter pattern of a stop list: ['X','Y','X','Y'] -> 'A-B-A-B'. The
    27th distinct stop is 'A1', the 53rd 'A2': every stop keeps a name of its
    own."""
    distinct = F.array_distinct(stops)

    def name(s):
        at = (F.array_position(distinct, s) - 1).cast("int")
        turn = F.floor(at / 26)
        return F.concat(F.chr(at % 26 + F.lit(65)), F.when(turn > 0, turn.cast("string")).otherwise(F.lit("")))

    return F.array_join(F.transform(stops, name), STOP_SEP)


def route_segments(schedule, factor=1.0, base: int = 1) -> Column:
    """Route schedule ``'A-B-C'`` -> ``array<string>`` of segment values
    ``mode*from-to*factor*ordinal``: ``['A-B-C*A-B*1.0*1', 'A-B-C*B-C*1.0*2']``.

    ``mode`` is the letter pattern of the stops (a round trip is
    ``A-B-A-B``), ``factor`` the share of the vehicle's rated capacity used on
    each segment (a number or a Column) and ``ordinal`` counts from ``base``.
    A null schedule gives null; fewer than two stops give an empty array.
    """
    sched = _col(schedule)
    stops = literal_split(sched, STOP_SEP)
    n = F.size(stops)
    mode = stop_pattern(stops)
    fac = (factor if isinstance(factor, Column) else F.lit(float(factor))).cast("double").cast("string")
    segs = F.transform(
        F.sequence(F.lit(1), n - 1),
        lambda k: F.concat_ws(
            SEGMENT_FIELD_SEP,
            mode,
            F.concat(F.get(stops, k - 1), F.lit(STOP_SEP), F.get(stops, k)),
            fac,
            (k + F.lit(base - 1)).cast("string")))
    return (F.when(sched.isNull(), F.lit(None).cast("array<string>"))
            .when(n >= 2, segs)
            .otherwise(F.array().cast("array<string>")))


def segment_fields(segment) -> dict[str, Column]:
    """Parse one segment value into its four fields (null when missing)."""
    seg = _col(segment)
    legs = split_at(seg, SEGMENT_FIELD_SEP, 1)
    return {
        "trans_mode": split_at(seg, SEGMENT_FIELD_SEP, 0),
        "trans_rodes": legs,
        "by_road_method": split_at(seg, SEGMENT_FIELD_SEP, 2),
        "by_road_num": split_at(seg, SEGMENT_FIELD_SEP, 3),
    }
