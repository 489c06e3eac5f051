"""Sales tables in the shape of bronze and silver, from TPC-H-shaped parquet files.

Columns without a source are left out, not invented.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smelter.plans.silver import silver_table

# Fixed value: product ids start here, so that no product id equals its surrogate key.
FIRST_PRODUCT = 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bronze_order_header(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("SalesOrderID"),
        F.col("o_orderstatus").alias("Status"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("o_orderpriority").alias("ShipMethod"),
        F.col("o_totalprice").alias("TotalDue"),
        F.col("o_orderdate").cast("date").alias("OrderDate"),
        F.col("o_orderkey").alias("rowguid"),
    )


def bronze_order_detail(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("SalesOrderID"),
        F.col("l_linenumber").alias("SalesOrderDetailID"),
        F.col("l_quantity").alias("OrderQty"),
        (F.col("l_partkey") + FIRST_PRODUCT).alias("ProductID"),
        F.try_divide("l_extendedprice", "l_quantity").alias("UnitPrice"),
        F.col("l_discount").alias("UnitPriceDIscount"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("LineTotal"),
        F.col("l_tax").alias("rowguid"),
    )


def bronze_customer(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("CustomerID"),
        F.col("c_mktsegment").alias("Title"),
        F.col("c_name").alias("CompanyName"),
        F.col("c_acctbal").alias("rowguid"),
    )


def bronze_customer_address(spark: SparkSession, folder: str) -> DataFrame:
    """A main office for nine customers in ten, a shipping address for one in seven."""
    customer, shipping = F.col("c_custkey"), F.col("number") == 1
    return (
        table(spark, folder, "customer")
        .select("c_custkey", "c_nationkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("number"))
        .where(F.when(shipping, customer % 7 == 0).otherwise(customer % 10 != 0))
        .select(
            customer.alias("CustomerID"),
            (customer * 2 + F.col("number")).alias("AddressID"),
            F.when(shipping, "Shipping").otherwise("Main Office").alias("AddressType"),
            F.col("c_nationkey").alias("rowguid"),
        )
    )


def bronze_product(
    spark: SparkSession, folder: str, category: DataFrame | None = None
) -> DataFrame:
    """Parts; pass ``category`` where it is at hand."""
    if category is None:
        category = bronze_product_category(spark, folder)
    return (
        table(spark, folder, "part")
        .join(category.select("ProductCategoryID", F.col("Name").alias("p_type")), "p_type")
        .select(
            (F.col("p_partkey") + FIRST_PRODUCT).alias("ProductID"),
            F.col("p_name").alias("Name"),
            F.col("p_brand").alias("ProductNumber"),
            F.col("p_retailprice").alias("ListPrice"),
            F.col("p_size").alias("Size"),
            "ProductCategoryID",
            F.col("p_partkey").alias("rowguid"),
        )
    )


def bronze_product_category(spark: SparkSession, folder: str) -> DataFrame:
    """The part types, numbered from 1 by name; there are a few of them, however many parts."""
    types = table(spark, folder, "part").select(F.col("p_type").alias("Name")).distinct()
    place = F.row_number().over(Window.orderBy("Name")).cast("bigint") - 1
    return types.withColumn("number", place).select(
        (F.col("number") + 1).cast("int").alias("ProductCategoryID"),
        F.lit(None).cast("int").alias("ParentProductCategoryID"),
        "Name",
        F.col("number").alias("rowguid"),
    )


# Silver table -> its bronze-shaped rows.
BRONZE = {
    "salesOrderHeader": bronze_order_header,
    "salesOrderDetail": bronze_order_detail,
    "salesCustomer": bronze_customer,
    "salesCustomerAddress": bronze_customer_address,
    "salesProductCategory": bronze_product_category,
    "salesProduct": bronze_product,
}


def bronze(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All six."""
    category = bronze_product_category(spark, folder)
    shared = {
        "salesProductCategory": category,
        "salesProduct": bronze_product(spark, folder, category),
    }
    return {
        name: shared[name] if name in shared else rows(spark, folder)
        for name, rows in BRONZE.items()
    }


def silver(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Silver table ``name``, with the columns that have a source."""
    return silver_table(name, BRONZE[name](spark, folder), partial=True)


def silver_products(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Products and their categories."""
    category = bronze_product_category(spark, folder)
    return (
        silver_table("salesProduct", bronze_product(spark, folder, category), partial=True),
        silver_table("salesProductCategory", category),
    )
