"""String clean-up and fixed-point formatting as Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumora.fixed_values import PROMPT_PREFIX

# Every Unicode separator plus the ASCII controls and the byte-order mark.
BLANK = r"[\t\n\x0B\f\r\p{Z}\x{FEFF}]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_blank(c: Column | str) -> Column:
    """Trim all Unicode blanks; Spark's own ``trim`` removes only U+0020."""
    return F.regexp_replace(_col(c), rf"\A{BLANK}+|{BLANK}+\z", "")


def first_filled(*columns: Column | str) -> Column:
    """First value that is neither NULL nor the empty string."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in columns])


def prompt(label: Column | str) -> Column:
    return F.concat(F.lit(PROMPT_PREFIX), _col(label))


def to_fixed(x: Column | str, digits: int) -> Column:
    """Round to ``digits`` by the exact binary value, exact ties upwards.

    ``x * 10^digits`` is split into its rounded product and the rounding error
    (Dekker), so a value just below a tie is not lifted over it.
    """
    x = _col(x).cast("double")
    scale = float(10 ** digits)
    split = 134217729.0
    big = x * split
    hi = big - (big - x)
    lo = x - hi
    product = x * scale                      # scale has few bits: no split needed
    error = (hi * scale - product) + lo * scale
    whole = F.floor(product).cast("double")
    excess = (product - whole) - 0.5
    up = (excess > 0.0) | ((excess == 0.0) & (error >= 0.0))
    # a product that landed on an integer from below belongs to the integer under it,
    # and rounds back up to the same value, so only the tie needs the error term
    return F.when(up, whole + 1.0).otherwise(whole) / scale


def fixed_text(x: Column | str, digits: int) -> Column:
    """``to_fixed`` as text with exactly ``digits`` decimals."""
    return F.format_string(f"%.{digits}f", to_fixed(x, digits))
