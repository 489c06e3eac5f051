from smelter.plans.gold import (
    dim_customer,
    dim_date,
    dim_date_covering,
    dim_product,
    dim_product_as_written,
    fact_sales,
    fact_sales_as_written,
    order_lines,
)
from smelter.plans.layers import run_gold, run_layers, run_silver
from smelter.plans.silver import SILVER_COLUMNS, SILVER_SOURCES, SILVER_TYPES, silver_table

__all__ = [
    "SILVER_COLUMNS",
    "SILVER_SOURCES",
    "SILVER_TYPES",
    "dim_customer",
    "dim_date",
    "dim_date_covering",
    "dim_product",
    "dim_product_as_written",
    "fact_sales",
    "fact_sales_as_written",
    "order_lines",
    "run_gold",
    "run_layers",
    "run_silver",
    "silver_table",
]
