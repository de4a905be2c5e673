"""Declared schemas of the source documents (MongoDB extended JSON).

Declaring the schema avoids an inference pass over the input and keeps every
field, including ones that occur only late in a file; a field absent from a
document reads as NULL.

Extended-JSON wrappers are structs: ``{"$oid": s}`` (object id),
``{"$date": ms}`` (epoch milliseconds) and ``{"$ref": r, "$id": {"$oid": s}}``
(reference). Loaded tables use snake_case names (:func:`snake_case`), the same
names the report operators use.
"""

from __future__ import annotations

import re

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
)

OID = StructType([StructField("$oid", StringType())])
DATE = StructType([StructField("$date", LongType())])
REF = StructType([StructField("$ref", StringType()), StructField("$id", OID)])

# Field names of the source documents, as they appear in the data.
ITEM_STRING_FIELDS = (
    "barcode",
    "description",
    "finalPrice",
    "itemPrice",
    "needsFetchReviewReason",
    "partnerItemId",
    "pointsNotAwardedReason",
    "pointsPayerId",
    "rewardsGroup",
    "rewardsProductPartnerId",
    "userFlaggedBarcode",
    "userFlaggedDescription",
    "userFlaggedPrice",
    "originalMetaBriteBarcode",
    "originalMetaBriteDescription",
    "brandCode",
    "competitorRewardsGroup",
    "discountedItemPrice",
    "originalReceiptItemText",
    "itemNumber",
    "pointsEarned",
    "targetPrice",
    "originalFinalPrice",
    "originalMetaBriteItemPrice",
    "priceAfterCoupon",
)
ITEM_LONG_FIELDS = ("quantityPurchased", "userFlaggedQuantity", "originalMetaBriteQuantityPurchased")
ITEM_BOOLEAN_FIELDS = (
    "needsFetchReview",
    "preventTargetGapPoints",
    "userFlaggedNewItem",
    "competitiveProduct",
    "deleted",
)
# Item fields that hold numbers as text and are loaded as DOUBLE.
ITEM_NUMERIC_TEXT_FIELDS = (
    "finalPrice",
    "itemPrice",
    "discountedItemPrice",
    "targetPrice",
    "priceAfterCoupon",
    "pointsEarned",
)
RECEIPT_DATE_FIELDS = (
    "createDate",
    "dateScanned",
    "finishedDate",
    "modifyDate",
    "pointsAwardedDate",
    "purchaseDate",
)
USER_DATE_FIELDS = ("createdDate", "lastLogin")

ITEM = StructType(
    [StructField(f, StringType()) for f in ITEM_STRING_FIELDS]
    + [StructField(f, LongType()) for f in ITEM_LONG_FIELDS]
    + [StructField(f, BooleanType()) for f in ITEM_BOOLEAN_FIELDS]
)

RECEIPT = StructType(
    [
        StructField("_id", OID),
        StructField("userId", StringType()),
        StructField("rewardsReceiptStatus", StringType()),
        *[StructField(f, DATE) for f in RECEIPT_DATE_FIELDS],
        StructField("bonusPointsEarned", LongType()),
        StructField("bonusPointsEarnedReason", StringType()),
        StructField("pointsEarned", StringType()),
        StructField("purchasedItemCount", LongType()),
        StructField("totalSpent", StringType()),
        StructField("rewardsReceiptItemList", ArrayType(ITEM)),
    ]
)

USER = StructType(
    [
        StructField("_id", OID),
        StructField("active", BooleanType()),
        StructField("createdDate", DATE),
        StructField("lastLogin", DATE),
        StructField("role", StringType()),
        StructField("signUpSource", StringType()),
        StructField("state", StringType()),
    ]
)

BRAND = StructType(
    [
        StructField("_id", OID),
        StructField("barcode", StringType()),
        StructField("category", StringType()),
        StructField("categoryCode", StringType()),
        StructField("name", StringType()),
        StructField("topBrand", BooleanType()),
        StructField("brandCode", StringType()),
        StructField("cpg", REF),
    ]
)

# Column renames that the camelCase rule does not give.
RENAMES = {"_id": "id", "rewardsReceiptStatus": "status"}

_UPPER = re.compile(r"(?<!^)(?=[A-Z])")


def snake_case(name: str) -> str:
    """``userFlaggedPrice`` -> ``user_flagged_price`` (plus :data:`RENAMES`)."""
    if name in RENAMES:
        return RENAMES[name]
    return _UPPER.sub("_", name).lower()
