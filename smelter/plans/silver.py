"""What each silver table keeps of its bronze view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from smelter.operators.project import project

# Silver table -> bronze view.
SILVER_SOURCES = {
    "salesOrderDetail": "salesltsalesorderdetail",
    "salesOrderHeader": "salesltsalesorderheader",
    "salesCustomer": "salesltcustomer",
    "salesCustomerAddress": "salesltcustomeraddress",
    "salesProduct": "salesltproduct",
    "salesProductCategory": "salesltproductcategory",
}

# Silver table -> columns, in table order.
SILVER_COLUMNS = {
    "salesOrderDetail": [
        "SalesOrderID", "OrderQty", "ProductID", "UnitPrice", "UnitPriceDiscount", "LineTotal",
    ],
    "salesOrderHeader": [
        "SalesOrderID", "RevisionNumber", "OrderDate", "DueDate", "ShipDate", "Status",
        "OnlineOrderFlag", "SalesOrderNumber", "PurchaseOrderNumber", "AccountNumber",
        "CustomerID", "ShipToAddressID", "BillToAddressID", "ShipMethod", "SubTotal", "TaxAmt",
        "Freight", "TotalDue",
    ],
    "salesCustomer": [
        "CustomerID", "Title", "FirstName", "MiddleName", "LastName", "Suffix", "CompanyName",
        "EmailAddress", "Phone",
    ],
    "salesCustomerAddress": ["CustomerID", "AddressID", "AddressType"],
    "salesProduct": [
        "ProductID", "Name", "ProductNumber", "Color", "StandardCost", "ListPrice", "Size",
        "Weight", "ProductCategoryID",
    ],
    "salesProductCategory": ["ProductCategoryID", "ParentProductCategoryID", "Name"],
}

# The types to expect in the text. Ids are bigint, to hold those of large tables.
SILVER_TYPES = {
    "SalesOrderID": "bigint",
    "OrderQty": "int",
    "ProductID": "bigint",
    "UnitPrice": "double",
    "UnitPriceDiscount": "double",
    "LineTotal": "double",
    "RevisionNumber": "int",
    "OrderDate": "timestamp",
    "DueDate": "timestamp",
    "ShipDate": "timestamp",
    "Status": "int",
    "OnlineOrderFlag": "boolean",
    "CustomerID": "bigint",
    "ShipToAddressID": "bigint",
    "BillToAddressID": "bigint",
    "SubTotal": "double",
    "TaxAmt": "double",
    "Freight": "double",
    "TotalDue": "double",
    "AddressID": "bigint",
    "StandardCost": "double",
    "ListPrice": "double",
    "Weight": "double",
    "ProductCategoryID": "int",
    "ParentProductCategoryID": "int",
}


def silver_table(
    name: str,
    bronze: DataFrame,
    where: Column | str | None = None,
    partial: bool = False,
) -> DataFrame:
    """The columns of silver table ``name`` from its bronze rows.

    A missing column is an error; with ``partial`` the table goes without it.
    """
    present = {column.lower() for column in bronze.columns}
    columns = [c for c in SILVER_COLUMNS[name] if not partial or c.lower() in present]
    return project(bronze, columns, where)
