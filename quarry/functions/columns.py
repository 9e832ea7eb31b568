"""Small reusable column expressions.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none needs a Python worker.
"""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction
from math import floor

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def half_up_pct(part: str | Column, total: str | Column) -> Column:
    """Percentage with two decimals, rounded half up on the binary value.

    ``floor(part * 10000 / total + 0.5) / 100``.  Written this way rather than
    ``round(x, 2)`` because SQL engines disagree on how to round exact
    halves of a double; this form is the same everywhere.  A zero total gives
    NULL instead of an ANSI division error.
    """
    ratio = F.try_divide(_c(part).cast("double") * F.lit(10000.0), _c(total).cast("double"))
    return F.floor(ratio + F.lit(0.5)).cast("double") / F.lit(100.0)


def hash_order_key(key: str | Column, seed: int | str) -> Column:
    """Repeatable pseudo-random sort key: hex md5 of ``"<seed>:<key>"``.

    Unlike ``rand()`` / ``randomSplit`` the value depends only on the row's
    key, so a recomputed partition (lost executor, different partitioning)
    gives exactly the same split.  Any SQL engine with ``md5`` reproduces it.
    """
    return F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))


def threshold_hex(fraction: float | Fraction, digits: int = 32) -> str:
    """Zero-padded lower-case hex of ``floor(fraction * 16**digits)``, exactly.

    An md5 is below it, as text, with this probability; 1 gives a text above
    every digest.  Floats stand for the simplest fraction nearby.
    """
    value = Fraction(fraction).limit_denominator(10 ** 9)
    if not 0 <= value <= 1:
        raise ValueError(f"fraction must be in [0, 1], got {fraction}")
    return "g" if value == 1 else format(floor(value * 16 ** digits), f"0{digits}x")


def suffix_label(host: str | Column, mapping: Mapping[str, str],
                 default: str = "Other") -> Column:
    """Label a host by its last dot-suffix (``.de`` -> ``Germany``).

    The suffix is taken case-insensitively (``H.DE`` counts as ``.de``).  The
    mapping becomes a literal map looked up per row, so there is no join and
    nothing to shuffle; ``try_element_at`` gives NULL for unknown suffixes
    under ANSI mode.
    """
    suffix = F.lower(F.regexp_extract(_c(host), r"(\.[^.]+)$", 1))
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k.lower()), F.lit(v)]
    lookup = F.create_map(*pairs)
    return F.coalesce(F.try_element_at(lookup, suffix), F.lit(default))


def round_sig(col: str | Column, digits: int) -> Column:
    """Round a double to ``digits`` significant digits (0 stays 0).

    ``round(x / 10**e, digits - 1) * 10**e`` with ``e = floor(log10 |x|)``;
    every step is a plain IEEE operation, so other SQL engines reproduce it.
    """
    x = _c(col).cast("double")
    e = F.floor(F.log10(F.abs(x)))
    scale = F.pow(F.lit(10.0), e)
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x / scale, digits - 1) * scale)
