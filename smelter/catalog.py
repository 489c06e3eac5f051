"""Every query the driver runs, next to the SQL that must give the same rows.

Where rows depend on the partitioning or on chance, the query returns what holds for all of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from smelter import fixtures
from smelter.functions import date_parts
from smelter.operators import (
    preview,
    project,
    scratch_path,
    spread_dates,
    stage,
    surrogate_key,
    write_table,
)
from smelter.plans import gold, run_gold, run_silver
from smelter.plans.silver import SILVER_SOURCES
from smelter.sources import read_bronze, read_table, register_bronze, register_tables
from smelter.together import together

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SPREAD_ANCHOR = "1998-01-01"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with its SQL if there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


# --- SQL of the silver tables, shared by the queries built on them ---

HEADER = """
    select o_orderkey as SalesOrderID, o_orderstatus as Status, o_custkey as CustomerID,
           o_orderpriority as ShipMethod, o_totalprice as TotalDue,
           cast(o_orderdate as date) as OrderDate
    from orders"""

DETAIL = """
    select l_orderkey as SalesOrderID, l_quantity as OrderQty, l_partkey + 1000 as ProductID,
           l_extendedprice / nullif(l_quantity, 0) as UnitPrice, l_discount as UnitPriceDiscount,
           l_extendedprice * (1 - l_discount) as LineTotal
    from lineitem"""

CUSTOMER = """
    select c_custkey as CustomerID, c_mktsegment as Title, c_name as CompanyName
    from customer"""

ADDRESS = """
    select c_custkey as CustomerID, c_custkey * 2 as AddressID, 'Main Office' as AddressType
    from customer where c_custkey % 10 <> 0
    union all
    select c_custkey, c_custkey * 2 + 1, 'Shipping' from customer where c_custkey % 7 = 0"""

CATEGORY = """
    select cast(row_number() over (order by p_type nulls first) as int) as ProductCategoryID,
           cast(null as int) as ParentProductCategoryID, p_type as Name
    from (select distinct p_type from part) t"""

PRODUCT = f"""
    select p_partkey + 1000 as ProductID, p_name as Name, p_brand as ProductNumber,
           p_retailprice as ListPrice, p_size as Size, pc.ProductCategoryID
    from part join ({CATEGORY}) pc on p_type = pc.Name"""

CUSTOMER_ADDRESS = f"""
    select sc.*, sca.AddressID, sca.AddressType
    from ({CUSTOMER}) sc join ({ADDRESS}) sca on sc.CustomerID = sca.CustomerID"""

# The natural keys, which are unique here.
CUSTOMER_ORDER = "CustomerID nulls first, AddressID nulls first"

PRODUCT_ORDER = "ProductID nulls first"

DIM_CUSTOMER = f"""
    select row_number() over (order by {CUSTOMER_ORDER}) - 1 as CustomerIDKey, t.*
    from ({CUSTOMER_ADDRESS}) t"""

DIM_PRODUCT_AS_WRITTEN = f"""
    select row_number() over (order by {CUSTOMER_ORDER}) - 1 as ProductIDKey, t.*
    from ({CUSTOMER_ADDRESS}) t"""

DIM_PRODUCT = f"""
    select row_number() over (order by {PRODUCT_ORDER}) - 1 as ProductIDKey, t.*
    from (select p.*, pc.ParentProductCategoryID, pc.Name as CategoryName
          from ({PRODUCT}) p left join ({CATEGORY}) pc
          on p.ProductCategoryID = pc.ProductCategoryID) t"""

# One row per customer: the main office if there is one, then the lowest address id.
CUSTOMER_KEY = f"""
    select CustomerID, CustomerIDKey from (
      select CustomerID, CustomerIDKey, row_number() over (
               partition by CustomerID
               order by case when AddressType = 'Main Office' then 0 else 1 end,
                        AddressID nulls last, CustomerIDKey) as choice
      from ({DIM_CUSTOMER}) d) c
    where choice = 1"""

# One row per product, should an id occur twice.
PRODUCT_KEY = f"""
    select ProductID, min(ProductIDKey) as ProductIDKey from ({DIM_PRODUCT}) d group by ProductID"""

LINE_COLUMNS = "sod.OrderQty, sod.ProductID, sod.UnitPrice, sod.UnitPriceDiscount, sod.LineTotal"


def fact_sql(header: str) -> str:
    return f"""
    select dp.ProductIDKey, dc.CustomerIDKey, soh.*, {LINE_COLUMNS}
    from ({header}) soh
    join ({DETAIL}) sod on soh.SalesOrderID = sod.SalesOrderID
    left join ({PRODUCT_KEY}) dp on sod.ProductID = dp.ProductID
    left join ({CUSTOMER_KEY}) dc on soh.CustomerID = dc.CustomerID"""


def spread_sql(rows: str) -> str:
    """``rows`` of headers with OrderDate spread over 365 days by the md5 of the order id.

    Every row gets a date, also one without an id.
    """
    return f"""
    select * exclude (OrderDate), date '{SPREAD_ANCHOR}' + cast(
             cast('0x' || substr(md5(coalesce(cast(SalesOrderID as varchar), '')), 1, 8) as bigint)
             % 365 as integer) as OrderDate
    from ({rows}) h"""


def date_parts_sql(date: str) -> str:
    return f"""cast(year({date}) as int) as Year, cast(month({date}) as int) as Month,
           cast(day({date}) as int) as DayOfMonth, cast(dayofyear({date}) as int) as DayOfYear,
           cast(weekofyear({date}) as int) as WeekOfYear,
           cast(dayofweek({date}) + 1 as int) as DayOfWeek,
           cast(quarter({date}) as int) as Quarter"""


def _anchor():
    return F.lit(SPREAD_ANCHOR).cast("date")


def _unique(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


# --- silver projections ---


@query(DETAIL)
def silver_order_detail(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.silver(spark, folder, "salesOrderDetail")


@query(HEADER)
def silver_order_header(spark: SparkSession, folder: str) -> DataFrame:
    """6 of 18 columns: the test tables have no source for the others."""
    return fixtures.silver(spark, folder, "salesOrderHeader")


@query(CUSTOMER)
def silver_customer(spark: SparkSession, folder: str) -> DataFrame:
    """3 of 9 columns: the test tables have no source for the others."""
    return fixtures.silver(spark, folder, "salesCustomer")


@query(ADDRESS)
def silver_customer_address(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.silver(spark, folder, "salesCustomerAddress")


@query(PRODUCT)
def silver_product(spark: SparkSession, folder: str) -> DataFrame:
    """6 of 9 columns: the test tables have no source for the others."""
    return fixtures.silver(spark, folder, "salesProduct")


@query(CATEGORY)
def silver_product_category(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.silver(spark, folder, "salesProductCategory")


@query(f"select * from ({HEADER}) h where Status = 'F'")
def silver_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """The optional row filter of the silver step."""
    header = fixtures.bronze_order_header(spark, folder)
    return project(header, header.drop("rowguid").columns, "Status = 'F'")


@query(spread_sql(HEADER))
def spread_dates_hash(spark: SparkSession, folder: str) -> DataFrame:
    return spread_dates(fixtures.silver(spark, folder, "salesOrderHeader"), anchor=_anchor())


@query(f"select * exclude (OrderDate), 1 as InRange from ({HEADER}) h")
def spread_dates_rand(spark: SparkSession, folder: str) -> DataFrame:
    """Drawn dates are not repeatable; what holds for each is that it is in the default range."""
    header = spread_dates(fixtures.silver(spark, folder, "salesOrderHeader"), mode="rand")
    first = F.date_sub(F.current_date(), 1000)
    in_range = F.col("OrderDate").between(first, F.date_add(first, 364))
    return header.withColumn("InRange", in_range.cast("int")).drop("OrderDate")


# --- dates ---


@query(f"""
    select SalesOrderID, OrderDate, {date_parts_sql("OrderDate")}
    from ({HEADER}) h""")
def order_date_parts(spark: SparkSession, folder: str) -> DataFrame:
    header = fixtures.silver(spark, folder, "salesOrderHeader")
    return header.select("SalesOrderID", "OrderDate", *date_parts(F.col("OrderDate")))


@query(f"""
    select SalesOrderID, OrderDate - 1000 as EarlierDate, OrderDate + 364 as LaterDate,
           cast(date_diff('day', date '{SPREAD_ANCHOR}', OrderDate) as int) as DaysSince
    from ({HEADER}) h""")
def order_date_arithmetic(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.silver(spark, folder, "salesOrderHeader").select(
        "SalesOrderID",
        F.date_sub("OrderDate", 1000).alias("EarlierDate"),
        F.date_add("OrderDate", 364).alias("LaterDate"),
        F.datediff("OrderDate", _anchor()).alias("DaysSince"),
    )


@query(f"""
    select Date, {date_parts_sql("Date")}
    from (select cast(unnest(generate_series(min(OrderDate), max(OrderDate), interval 1 day))
                      as date) as Date
          from ({HEADER}) h) d""")
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar from the first to the last order date."""
    return gold.dim_date_covering(fixtures.silver(spark, folder, "salesOrderHeader"), "OrderDate")


@query(f"""
    select SalesOrderID, OrderDate, d.*
    from ({HEADER}) h left join (
      select Date, {date_parts_sql("Date")}
      from (select cast(unnest(generate_series(date '1995-01-01', date '2001-12-31',
                                               interval 1 day)) as date) as Date) s) d
    on OrderDate = Date""")
def order_dates_in_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates looked up in a calendar with fixed bounds."""
    header = fixtures.silver(spark, folder, "salesOrderHeader").select("SalesOrderID", "OrderDate")
    calendar = gold.dim_date(spark, "1995-01-01", "2001-12-31")
    return header.join(calendar, header.OrderDate == calendar.Date, "left")


# --- dimensions ---


@query(DIM_CUSTOMER)
def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_customer(
        fixtures.silver(spark, folder, "salesCustomer"),
        fixtures.silver(spark, folder, "salesCustomerAddress"),
    )


def _monotonic(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_customer(
        fixtures.silver(spark, folder, "salesCustomer"),
        fixtures.silver(spark, folder, "salesCustomerAddress"),
        mode="monotonic",
    )


@query(CUSTOMER_ADDRESS)
def dim_customer_monotonic(spark: SparkSession, folder: str) -> DataFrame:
    """The rows under monotonic keys, without the keys, which differ from run to run."""
    return _monotonic(spark, folder).drop("CustomerIDKey")


@query(f"select count(*) as RowCount, count(*) as KeyCount from ({CUSTOMER_ADDRESS}) t")
def dim_customer_monotonic_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The keys differ from run to run; what holds in each is that no two rows share one."""
    return _monotonic(spark, folder).agg(
        F.count("*").alias("RowCount"), F.countDistinct("CustomerIDKey").alias("KeyCount")
    )


@query(DIM_PRODUCT)
def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_product(*fixtures.silver_products(spark, folder))


@query(DIM_PRODUCT_AS_WRITTEN)
def dim_product_as_written(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_product_as_written(
        fixtures.silver(spark, folder, "salesCustomer"),
        fixtures.silver(spark, folder, "salesCustomerAddress"),
    )


@query(f"""
    select row_number() over (order by TotalDue nulls first, SalesOrderID nulls first,
             CustomerID nulls first, OrderDate nulls first, ShipMethod nulls first) - 1
           as OrderKey, h.* exclude (Status)
    from ({HEADER}) h""")
def order_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Dense keys over a large table, with a column left out."""
    header = fixtures.silver(spark, folder, "salesOrderHeader")
    order = ["TotalDue", "SalesOrderID", "CustomerID", "OrderDate", "ShipMethod"]
    return surrogate_key(header, "OrderKey", order, exclude=["Status"])


# --- order lines and facts ---


@query(f"""
    select soh.*, {LINE_COLUMNS}
    from ({HEADER}) soh join ({DETAIL}) sod on soh.SalesOrderID = sod.SalesOrderID""")
def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return gold.order_lines(
        fixtures.silver(spark, folder, "salesOrderHeader"),
        fixtures.silver(spark, folder, "salesOrderDetail"),
    )


@query(fact_sql(HEADER))
def fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fact_sales(
        fixtures.silver(spark, folder, "salesOrderHeader"),
        fixtures.silver(spark, folder, "salesOrderDetail"),
        *together(
            spark, lambda: dim_product(spark, folder), lambda: dim_customer(spark, folder)
        ),
    )


@query(f"""
    select dp.ProductIDKey, dc.CustomerIDKey, soh.*, {LINE_COLUMNS}
    from ({HEADER}) soh
    join ({DETAIL}) sod on soh.SalesOrderID = sod.SalesOrderID
    left join ({DIM_PRODUCT_AS_WRITTEN}) dp on sod.ProductID = dp.ProductIDKey
    left join ({DIM_CUSTOMER}) dc on soh.CustomerID = dc.CustomerID""")
def fact_sales_as_written(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fact_sales_as_written(
        fixtures.silver(spark, folder, "salesOrderHeader"),
        fixtures.silver(spark, folder, "salesOrderDetail"),
        *together(
            spark,
            lambda: dim_product_as_written(spark, folder),
            lambda: dim_customer(spark, folder),
        ),
    )


# --- files, views and tables ---


def _bronze_files(root: str, tables: dict[str, DataFrame]) -> dict[str, StructType]:
    """Write CSV folders named as bronze files are; return the schema of each by view name."""

    def write(name: str, rows: DataFrame) -> tuple[str, StructType]:
        view = SILVER_SOURCES[name]
        rows.write.csv(f"{root}/{view.replace('saleslt', 'SalesLT.')}.csv", header=True)
        return view, rows.schema

    spark = next(iter(tables.values())).sparkSession
    return dict(together(spark, *[partial(write, *item) for item in tables.items()]))


@query(CUSTOMER)
def bronze_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as a CSV file, registered as a view with a given schema."""
    root = scratch_path(spark, "bronze")
    schemas = _bronze_files(root, {"salesCustomer": fixtures.bronze_customer(spark, folder)})
    views = register_bronze(spark, root, schemas)
    return views["SalesLTcustomer"].select("CustomerID", "Title", "CompanyName")


@query(f"""
    select cast(SalesOrderID as int) as SalesOrderID, Status, cast(CustomerID as int) as CustomerID,
           ShipMethod, TotalDue, OrderDate
    from ({HEADER}) h""")
def bronze_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """Order headers as a CSV file, with the types found in the text."""
    root = scratch_path(spark, "bronze")
    _bronze_files(root, {"salesOrderHeader": fixtures.bronze_order_header(spark, folder)})
    views = register_bronze(spark, root)
    return views["SalesLTsalesorderheader"].select(
        F.col("SalesOrderID").cast("int").alias("SalesOrderID"),
        "Status",
        F.col("CustomerID").cast("int").alias("CustomerID"),
        "ShipMethod",
        "TotalDue",
        "OrderDate",
    )


@query(f"{CUSTOMER} union all {CUSTOMER}")
def bronze_glob(spark: SparkSession, folder: str) -> DataFrame:
    """Two CSV files with one prefix, read as one by the prefix."""
    root = scratch_path(spark, "bronze")
    customers = fixtures.bronze_customer(spark, folder)
    for name in ("SalesLT.Customer.csv", "SalesLT.Customer.csv.part2"):
        customers.write.csv(f"{root}/{name}", header=True)
    rows = read_bronze(spark, f"{root}/SalesLT.Customer.csv", customers.schema, glob_suffix="*")
    return rows.select("CustomerID", "Title", "CompanyName")


@query(DETAIL)
def table_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines written as an external table and read back from its folder."""
    root, name = scratch_path(spark, "silver"), _unique("salesOrderDetail")
    write_table(fixtures.silver(spark, folder, "salesOrderDetail"), root, name)
    return read_table(spark, f"{root}/{name}/")


@query(HEADER)
def catalog_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Order headers written as an external table and read back from the catalog."""
    root, name = scratch_path(spark, "silver"), _unique("salesOrderHeader")
    return write_table(fixtures.silver(spark, folder, "salesOrderHeader"), root, name)


@query(ADDRESS)
def view_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Every column of a registered table folder, by view name in another case."""
    root, name = scratch_path(spark, "silver"), _unique("salesCustomerAddress")
    write_table(fixtures.silver(spark, folder, "salesCustomerAddress"), root, name)
    register_tables(spark, root)
    return spark.sql(f"SELECT * FROM {name.upper()}")


@query(f"""
    select least(count(*), 100) as RowCount, least(count(*), 100) as FoundCount
    from ({HEADER}) h""")
def preview_order_header(spark: SparkSession, folder: str) -> DataFrame:
    """Which rows a preview has is open; what holds is their number, and that the table has them."""
    header = fixtures.silver(spark, folder, "salesOrderHeader")
    shown = stage(preview(header, 100), "preview")
    found = shown.intersectAll(header).select(F.lit(0).alias("shown"), F.lit(1).alias("found"))
    both = shown.select(F.lit(1).alias("shown"), F.lit(0).alias("found")).unionAll(found)
    return both.agg(F.sum("shown").alias("RowCount"), F.sum("found").alias("FoundCount"))


@query(f"select * from ({HEADER}) h order by SalesOrderID limit 100")
def preview_first_orders(spark: SparkSession, folder: str) -> DataFrame:
    """A preview with an order: only the first rows of each partition travel."""
    return preview(fixtures.silver(spark, folder, "salesOrderHeader").orderBy("SalesOrderID"), 100)


def _layers(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """CSV files through silver to gold, in a database that goes afterwards; gold table ``name``."""
    root, database = scratch_path(spark, "layers"), _unique("smelter")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    schemas = _bronze_files(f"{root}/bronze", fixtures.bronze(spark, folder))
    run_silver(
        spark,
        f"{root}/bronze",
        f"{root}/silver",
        database=database,
        schemas=schemas,
        anchor=_anchor(),
        partial=True,
    )
    run_gold(spark, f"{root}/silver", f"{root}/gold", database=database)
    spark.sql(f"DROP DATABASE {database} CASCADE")  # the tables are external: their files stay
    return read_table(spark, f"{root}/gold/{name}")


@query(DIM_CUSTOMER)
def gold_dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    """The customer dimension that the gold step writes."""
    return _layers(spark, folder, "dimCustomer")


@query(DIM_PRODUCT)
def gold_dim_product(spark: SparkSession, folder: str) -> DataFrame:
    """The product dimension that the gold step writes."""
    return _layers(spark, folder, "dimProduct")


@query(f"""
    select Date, {date_parts_sql("Date")}
    from (select cast(unnest(generate_series(least(min(OrderDate), date '2000-01-01'),
                                             greatest(max(OrderDate), date '2024-12-31'),
                                             interval 1 day)) as date) as Date
          from ({spread_sql(HEADER)}) h) d""")
def gold_dim_date(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar that the gold step writes, with its usual bounds moved out to the order dates.
    """
    return _layers(spark, folder, "dimDate")


@query(fact_sql(spread_sql(HEADER)))
def gold_fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The sales fact after all layers, from CSV text to the gold table."""
    return _layers(spark, folder, "factSales")
