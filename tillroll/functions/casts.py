"""Lenient text-to-number casts.

The source documents carry prices and barcodes as text. A value that is not a
number becomes NULL instead of failing the load. ``try_cast`` alone is more
permissive than intended (Spark trims blanks and accepts ``'1.5d'``, ``'NaN'``
and ``'Infinity'``; engines disagree on ``'12.5'`` to BIGINT), so the accepted
text is exactly what :data:`INTEGER_PATTERN` / :data:`DECIMAL_PATTERN` match.

The guard is evaluated as "only characters of the number alphabet" (one
``translate`` per value, cheaper than a regular expression per row) followed
by ``try_cast``: the JVM number grammar restricted to that alphabet is the
pattern, so the two agree on every input (``tests/test_functions.py`` checks
the pair against the pattern on generated strings).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# What counts as an integer / decimal number in source text.
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
DECIMAL_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_ALPHABET = "0123456789+-"
DECIMAL_ALPHABET = "0123456789+-.eE"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_leading_dollar(text: ColumnOrName) -> Column:
    """Remove one leading ``$`` from price text (``'$1.50'`` -> ``'1.50'``)."""
    c = _col(text)
    return F.when(c.startswith("$"), c.substr(F.lit(2), F.length(c))).otherwise(c)


def only_chars(text: Column, alphabet: str) -> Column:
    """True when ``text`` has no character outside ``alphabet``."""
    return F.translate(text, alphabet, "") == ""


def lenient_bigint(text: ColumnOrName) -> Column:
    """Text to BIGINT; anything but an optionally signed digit run is NULL."""
    c = _col(text).cast("string")
    return F.when(only_chars(c, INTEGER_ALPHABET), c.try_cast("bigint"))


def lenient_double(text: ColumnOrName, strip_dollar: bool = True) -> Column:
    """Text to DOUBLE; non-numeric text (``''``, ``'abc'``, ``'1.5d'``) is NULL.

    With ``strip_dollar`` a leading ``$`` is removed first.
    """
    c = _col(text).cast("string")
    if strip_dollar:
        c = strip_leading_dollar(c)
    return F.when(only_chars(c, DECIMAL_ALPHABET), c.try_cast("double"))
