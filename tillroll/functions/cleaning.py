"""Item-level cleaning rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions.casts import lenient_double

ColumnOrName = Column | str

# Fixed value: the placeholder text a scanner writes for an unknown item.
NOT_FOUND_DESCRIPTION = "ITEM NOT FOUND"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_quantity(
    quantity: ColumnOrName = "quantity_purchased",
    flagged: ColumnOrName = "user_flagged_quantity",
) -> Column:
    """Purchased quantity, falling back to the user-flagged quantity."""
    return F.coalesce(_col(quantity), _col(flagged))


def clean_price(
    price: ColumnOrName = "final_price",
    flagged_text: ColumnOrName = "user_flagged_price",
) -> Column:
    """Final price (DOUBLE), falling back to the user-flagged price text.

    The flagged price is text; it is parsed leniently, so a value that is not
    a number gives NULL rather than an error.
    """
    return F.coalesce(_col(price).cast("double"), lenient_double(flagged_text, strip_dollar=False))


def spend(quantity: ColumnOrName, price: ColumnOrName) -> Column:
    """Quantity times price; NULL when either side is NULL."""
    return _col(quantity) * _col(price)


def is_blank_description(
    description: ColumnOrName = "description",
    markers: tuple[str, ...] = (NOT_FOUND_DESCRIPTION,),
) -> Column:
    """True for a missing, blank or placeholder item description."""
    d = _col(description)
    return (F.trim(F.coalesce(d, F.lit(""))) == "") | d.isin(*markers)


def both_present_and_different(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a IS NOT NULL AND b IS NOT NULL AND a != b``."""
    ca, cb = _col(a), _col(b)
    return ca.isNotNull() & cb.isNotNull() & (ca != cb)
