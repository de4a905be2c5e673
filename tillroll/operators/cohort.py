"""The recent-user cohort: users created in the last N months of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import minus_months, month_start


def cohort_start(users: DataFrame, months: int = 6, created_col: str = "created_date") -> Column:
    """``date_trunc('month', max(created)) - INTERVAL months`` as a scalar subquery.

    The maximum is a one-row aggregate (partial max per task, one row per
    task to the final step), evaluated once and used as a literal.
    """
    latest_month = users.select(month_start(F.max(created_col))).scalar()
    return minus_months(latest_month, months)


def recent_users(
    users: DataFrame,
    months: int = 6,
    exclude_roles: Sequence[str] | None = None,
    created_col: str = "created_date",
    role_col: str = "role",
) -> DataFrame:
    """Users created on or after :func:`cohort_start`.

    With ``exclude_roles`` the roles listed are removed with ``role NOT IN``;
    as in SQL, a NULL role does not pass that test either.
    """
    out = users.where(F.col(created_col) >= cohort_start(users, months, created_col))
    if exclude_roles:
        out = out.where(~F.col(role_col).isin(*exclude_roles))
    return out
