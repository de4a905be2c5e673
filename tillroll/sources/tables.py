"""The four receipt tables as DataFrames over the driver's parquet tables.

The analytics operate on four relations -- receipts, receipt items, users and
brands -- with the column names below. On the test data these are projections
of the TPC-H-like tables (one row in, one row out, every row kept), with
deterministic NULLs injected so the cleaning and audit rules have something to
do. They are plain ``select`` expressions, so Catalyst prunes each scan to the
columns a query uses and pushes filters on the mapped columns into the parquet
reader.

========= ======================== ==========================================
view      from                     columns
========= ======================== ==========================================
receipts  orders                   id, user_id, create_date, status,
                                   purchased_item_count
items     lineitem                 receipt_id, line_no, brand_code,
                                   description, quantity_purchased,
                                   user_flagged_quantity, final_price,
                                   user_flagged_price, original_meta_brite_item_price
users     customer                 id, created_date, role
brands    part                     brand_code, name, category
events    events                   event_id, ts, user_id, event_type, value, props
========= ======================== ==========================================

:data:`VIEW_SQL` holds the same definitions as SQL text for the DuckDB oracle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources import schemas as S

# Fixed values of the mapping.
STAFF_SEGMENT = "MACHINERY"
STAFF_ROLE = "staff"
CONSUMER_ROLE = "consumer"
BRAND_CODE_PREFIX = "BC"
USER_EPOCH = _dt.datetime(1995, 1, 1)


# Column types of the driver's parquet tables. Declaring them
# skips schema inference (a footer read per table, a Spark job on a directory
# of many files) and pins the types the views rely on.
TABLE_SCHEMAS: dict[str, str] = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; known tables with their declared schema."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The views are written as SQL expressions and applied with ``selectExpr``:
# the JVM parses them in one call, instead of one Python-to-JVM round trip per
# column function.
RECEIPTS_EXPR = (
    "o_orderkey as id",
    "o_custkey as user_id",
    "o_orderdate as create_date",
    "case o_orderstatus when 'F' then 'FINISHED' when 'O' then 'REJECTED' else 'PENDING' end as status",
    "case when o_orderkey % 7 = 0 then cast(null as bigint) else o_orderkey % 11 end as purchased_item_count",
)
ITEMS_EXPR = (
    "l_orderkey as receipt_id",
    "l_linenumber as line_no",
    "case when l_partkey % 5 = 0 then cast(null as string) "
    f"else concat('{BRAND_CODE_PREFIX}', cast(l_partkey as string)) end as brand_code",
    "case when l_linenumber % 7 = 0 then 'ITEM NOT FOUND' when l_linenumber % 5 = 0 then ' ' "
    "when l_linenumber % 4 = 0 then cast(null as string) else l_returnflag end as description",
    "case when l_linenumber % 3 = 0 then cast(null as bigint) "
    "else cast(l_quantity as bigint) end as quantity_purchased",
    "case when l_linenumber % 2 = 0 then cast(null as bigint) "
    "else cast(l_quantity as bigint) + l_orderkey % 2 end as user_flagged_quantity",
    "case when l_linenumber % 4 = 0 then cast(null as double) else l_extendedprice end as final_price",
    "case when l_linenumber % 5 = 0 then cast(null as string) "
    "else cast(cast(l_extendedprice as decimal(18,2)) as string) end as user_flagged_price",
    "case when l_linenumber = 1 then cast(cast(l_tax as decimal(18,2)) as string) end as original_meta_brite_item_price",
)
USERS_EXPR = (
    "c_custkey as id",
    f"timestamp_ntz'{USER_EPOCH.isoformat(sep=' ')}' + make_dt_interval(cast(c_custkey as int)) as created_date",
    f"case when c_mktsegment = '{STAFF_SEGMENT}' then '{STAFF_ROLE}' else '{CONSUMER_ROLE}' end as role",
)
BRANDS_EXPR = (
    f"concat('{BRAND_CODE_PREFIX}', cast(p_partkey as string)) as brand_code",
    "p_brand as name",
    "p_type as category",
)


def receipts_view(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(*RECEIPTS_EXPR)


def items_view(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(*ITEMS_EXPR)


def users_view(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(*USERS_EXPR)


def brands_view(part: DataFrame) -> DataFrame:
    return part.selectExpr(*BRANDS_EXPR)


def events_view(events: DataFrame) -> DataFrame:
    return events


class Tables:
    """The receipt tables of one data directory, read on first use.

    A query touches only the tables it names, so a report on receipts alone
    never lists or opens the item files.
    """

    _VIEWS = {
        "receipts": ("orders", receipts_view),
        "items": ("lineitem", items_view),
        "users": ("customer", users_view),
        "brands": ("part", brands_view),
        "events": ("events", events_view),
    }

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    @classmethod
    def from_dir(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        return cls(spark, sf_dir)

    def _get(self, name: str) -> DataFrame:
        if name not in self._cache:
            source, view = self._VIEWS[name]
            self._cache[name] = view(read_table(self.spark, self.sf_dir, source))
        return self._cache[name]

    def by_receipt(self, name: str) -> DataFrame:
        """``receipts`` or ``items`` with the rows of a receipt in one task. They are
        moved as the driver's table has them, which is narrower than the view."""
        source, view = self._VIEWS[name]
        key = {"receipts": "o_orderkey", "items": "l_orderkey"}[name]
        return view(read_table(self.spark, self.sf_dir, source).repartition(key))

    @property
    def receipts(self) -> DataFrame:
        return self._get("receipts")

    @property
    def items(self) -> DataFrame:
        return self._get("items")

    @property
    def users(self) -> DataFrame:
        return self._get("users")

    @property
    def brands(self) -> DataFrame:
        return self._get("brands")

    @property
    def events(self) -> DataFrame:
        return self._get("events")

    def register(self, prefix: str = "") -> None:
        """Register the tables as temp views (``receipts``, ``items``, ...)."""
        for name in self._VIEWS:
            self._get(name).createOrReplaceTempView(prefix + name)


# The same mapping as SQL text (DuckDB dialect; also valid Spark SQL apart
# from the NTZ cast of ``created_date``). Used by the oracle queries.
VIEW_SQL: dict[str, str] = {
    "receipts": """
select o_orderkey as id, o_custkey as user_id, o_orderdate as create_date,
  case o_orderstatus when 'F' then 'FINISHED' when 'O' then 'REJECTED' else 'PENDING' end as status,
  case when o_orderkey % 7 = 0 then null else o_orderkey % 11 end as purchased_item_count
from orders""",
    "items": """
select l_orderkey as receipt_id, l_linenumber as line_no,
  case when l_partkey % 5 = 0 then null else concat('BC', cast(l_partkey as varchar)) end as brand_code,
  case when l_linenumber % 7 = 0 then 'ITEM NOT FOUND' when l_linenumber % 5 = 0 then ' '
       when l_linenumber % 4 = 0 then null else l_returnflag end as description,
  case when l_linenumber % 3 = 0 then null else cast(l_quantity as bigint) end as quantity_purchased,
  case when l_linenumber % 2 = 0 then null else cast(l_quantity as bigint) + l_orderkey % 2 end as user_flagged_quantity,
  case when l_linenumber % 4 = 0 then null else l_extendedprice end as final_price,
  case when l_linenumber % 5 = 0 then null else cast(cast(l_extendedprice as decimal(18,2)) as varchar) end as user_flagged_price,
  case when l_linenumber = 1 then cast(cast(l_tax as decimal(18,2)) as varchar) end as original_meta_brite_item_price
from lineitem""",
    "users": """
select c_custkey as id,
  timestamp '1995-01-01 00:00:00' + cast(c_custkey as integer) * interval '1' day as created_date,
  case when c_mktsegment = 'MACHINERY' then 'staff' else 'consumer' end as role
from customer""",
    "brands": """
select concat('BC', cast(p_partkey as varchar)) as brand_code, p_brand as name, p_type as category
from part""",
}


def with_views_sql(body: str, views: tuple[str, ...] = ("receipts", "items", "users", "brands")) -> str:
    """Prefix ``body`` with the mapping views as CTEs."""
    ctes = ",\n".join(f"{name} as ({VIEW_SQL[name]}\n)" for name in views)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


# --- the fields that the views lack, for the loader checks -------------------
#
# Rules in SQL that Spark and DuckDB read alike, over the views' own columns:
# column -> its value in the table. Optional values stand on some rows only.
RECEIPT_FIELDS: dict[str, str] = {
    "date_scanned": "create_date + interval '1' hour",
    "finished_date": "case when status = 'FINISHED' then create_date + interval '2' day end",
    "modify_date": "create_date + interval '3' day",
    "points_awarded_date": "case when status <> 'PENDING' then create_date + interval '36' hour end",
    "purchase_date": "case when purchased_item_count is not null then create_date - interval '5' minute end",
    "bonus_points_earned": "case when purchased_item_count > 5 then purchased_item_count * 25 end",
    "bonus_points_earned_reason": "case when purchased_item_count > 5 then 'MANY \"ITEMS\"' end",
    "points_earned": "cast(purchased_item_count as string) || '.0'",
    "total_spent": "case when status <> 'PENDING' then cast(id as string) || '.50' end",
}
USER_FIELDS: dict[str, str] = {
    "active": "role = 'consumer'",
    "last_login": "case when role = 'consumer' then created_date + interval '5' day end",
    "sign_up_source": "case when role = 'staff' then 'Office' else 'Email' end",
    "state": "case when role = 'consumer' then 'WI' end",
}
BRAND_FIELDS: dict[str, str] = {
    "barcode": "case when name < 'Brand#2' then 'N' || brand_code else lpad(substr(brand_code, 3), 12, '0') end",
    "category_code": "case when name < 'Brand#3' then upper(category) end",
    "top_brand": "case when name > 'Brand#2' then name > 'Brand#4' end",
}


def _item_fields(line_no: str = "line_no") -> tuple[dict[str, str], dict[str, str]]:
    """The other item fields, as written into the documents and as loaded.

    Text and counts follow from the line number and numbers written as text
    are sometimes no number, which loads as NULL. ``line_no`` is how the rules
    name the line number.
    """
    known = {"description", "brand_code", "item_number", "final_price", "quantity_purchased"}
    known |= {"user_flagged_quantity", "user_flagged_price", "original_meta_brite_item_price"}
    written, loaded = {}, {}
    for f in S.ITEM.fields:
        name = S.snake_case(f.name)
        if name in known:
            continue
        if f.name in S.ITEM_NUMERIC_TEXT_FIELDS:
            written[name] = f"case when {line_no} = 5 then 'n/a' when {line_no} < 5 then cast({line_no} as string) || '.25' end"
            loaded[name] = f"case when {line_no} < 5 then cast({line_no} as double) + cast(0.25 as double) end"
            continue
        rule = {
            "string": f"case when {line_no} <> 3 then '{name} ' || cast({line_no} as string) end",
            "bigint": f"case when {line_no} <> 2 then cast({line_no} as bigint) * 2 end",
            "boolean": f"case when {line_no} <> 4 then {line_no} > 2 end",
        }[f.dataType.simpleString()]
        written[name] = loaded[name] = rule
    return written, loaded


ITEM_FIELDS_WRITTEN, ITEM_FIELDS_LOADED = _item_fields()
#: The same fields of an element ``line`` of a receipt's list of items.
ITEM_FIELDS_OF_LINE = _item_fields("line.line_no")[0]


def with_fields(table: DataFrame, fields: dict[str, str]) -> DataFrame:
    return table.selectExpr("*", *[f"{rule} as {name}" for name, rule in fields.items()])


def fields_sql(fields: dict[str, str]) -> str:
    return ", ".join(f"{rule} as {name}" for name, rule in fields.items())
