"""Bitmap offsets for user ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.functions.times import as_col

# Multiplier and bitmap size decide which ids share a bit, so they
# must stay as they are for equal counts.
SEED = 61
BITS = 30

#: A BIGINT has at most 19 digits and a sign.
_LONG_TEXT = 20


def poly_offset(value: str | Column, seed: int = SEED, bits: int = BITS, max_len: int = _LONG_TEXT) -> Column:
    """Polynomial hash of the text of ``value``, reduced to ``bits`` bits.

    The polynomial is summed term by term with its powers already reduced, which
    keeps every product inside a BIGINT under ANSI arithmetic and stays in
    generated code (a higher-order ``aggregate`` over characters would not).
    Positions past the end of the text contribute nothing.  ``max_len`` must
    cover the longest text; longer texts fail instead of hashing a prefix.
    """
    size = 1 << bits
    text = as_col(value).cast("string")
    total = F.lit(0).cast("bigint")
    for power in range(max_len):
        code = F.ascii(F.substring(text, -(power + 1), 1)).cast("bigint")
        total = total + code * F.lit(pow(seed, power, size))
    return F.when(
        F.length(text) > max_len, F.raise_error(F.lit(f"poly_offset: text longer than {max_len} characters"))
    ).otherwise(total.bitwiseAND(F.lit(size - 1)))
