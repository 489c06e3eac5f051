"""CSV files through silver to gold, with every column of the source system."""

import datetime

import pytest
from pyspark.sql import functions as F

from smelter.plans import SILVER_COLUMNS, SILVER_TYPES, run_gold, run_layers, run_silver
from smelter.sources import read_table

FILES = {
    "SalesLT.SalesOrderDetail.csv": """SalesOrderID,SalesOrderDetailID,OrderQty,ProductID,UnitPrice,UnitPriceDiscount,LineTotal,rowguid
1,1,2,707,10.5,0.0,21.0,g1
1,2,1,708,5.0,0.1,4.5,g2
2,3,3,707,10.5,0.0,31.5,g3
3,4,1,999,1.0,0.0,1.0,g4
""",
    "SalesLT.SalesOrderHeader.csv": """SalesOrderID,RevisionNumber,OrderDate,DueDate,ShipDate,Status,OnlineOrderFlag,SalesOrderNumber,PurchaseOrderNumber,AccountNumber,CustomerID,ShipToAddressID,BillToAddressID,ShipMethod,CreditCardApprovalCode,SubTotal,TaxAmt,Freight,TotalDue,Comment,rowguid
1,2,2008-06-01 00:00:00,2008-06-13 00:00:00,2008-06-08 00:00:00,5,False,SO1,PO1,A-1,10,100,100,CARGO,,25.5,2.0,1.0,28.5,,g
2,2,2008-06-01 00:00:00,2008-06-13 00:00:00,2008-06-08 00:00:00,5,True,SO2,PO2,A-2,11,102,102,CARGO,,31.5,2.0,1.0,34.5,,g
3,2,2008-06-01 00:00:00,2008-06-13 00:00:00,2008-06-08 00:00:00,5,False,SO3,PO3,A-3,12,103,103,CARGO,,1.0,0.1,0.1,1.2,,g
4,2,2008-06-01 00:00:00,2008-06-13 00:00:00,2008-06-08 00:00:00,5,False,SO4,PO4,A-1,10,100,100,CARGO,,0.0,0.0,0.0,0.0,,g
""",
    "SalesLT.Customer.csv": """CustomerID,NameStyle,Title,FirstName,MiddleName,LastName,Suffix,CompanyName,SalesPerson,EmailAddress,Phone,PasswordHash
10,False,Mr.,Ann,B.,Lee,,"Bikes, Ltd",sp,a@example.com,555-0101,h
11,False,Ms.,Bo,,Kim,Jr.,Wheels,sp,b@example.com,555-0102,h
12,False,,Cy,,Ray,,Gears,sp,c@example.com,555-0103,h
""",
    "SalesLT.CustomerAddress.csv": """CustomerID,AddressID,AddressType,rowguid
10,101,Shipping,g
10,100,Main Office,g
11,102,Main Office,g
""",
    "SalesLT.Product.csv": """ProductID,Name,ProductNumber,Color,StandardCost,ListPrice,Size,Weight,ProductCategoryID,ProductModelID
707,Helmet,HL-1,Red,13.0,35.0,M,,2,33
708,Frame,FR-1,Black,100.0,200.5,58,1016.04,3,6
""",
    "SalesLT.ProductCategory.csv": """ProductCategoryID,ParentProductCategoryID,Name,rowguid
1,,Bikes,g
2,,Accessories,g
3,1,Frames,g
""",
    "SalesLT.Address.csv": """AddressID,City
100,Reno
""",
}


@pytest.fixture
def bronze(tmp_path):
    root = tmp_path / "bronze"
    root.mkdir()
    for name, text in FILES.items():
        (root / name).write_text(text)
    return str(root)


def test_all_layers(spark, bronze, tmp_path, database):
    silver_root, gold_root = str(tmp_path / "silver"), str(tmp_path / "gold")
    tables = run_layers(spark, bronze, silver_root, gold_root, database=database)
    assert len(tables) == 10

    assert spark.sql("SELECT * FROM salesltaddress LIMIT 100").count() == 1
    for name, columns in SILVER_COLUMNS.items():
        kept = read_table(spark, f"{silver_root}/{name}").columns
        if name == "salesOrderHeader":
            columns = [c for c in columns if c != "OrderDate"] + ["OrderDate"]
        assert kept == columns
    ages = tables["salesOrderHeader"].select(F.datediff(F.current_date(), "OrderDate").alias("n"))
    assert all(636 <= row.n <= 1000 for row in ages.collect())

    fact = spark.table(f"{database}.factSales")
    assert len(fact.columns) == 25
    assert fact.agg(F.count("*"), F.sum("LineTotal")).first() == (4, 58.0)
    got = fact.select("SalesOrderNumber", "ProductIDKey", "CustomerIDKey", "LineTotal")
    assert sorted(map(tuple, got.collect()), key=str) == [
        ("SO1", 0, 0, 21.0),
        ("SO1", 1, 0, 4.5),
        ("SO2", 0, 2, 31.5),
        ("SO3", None, None, 1.0),
    ]
    assert len(tables["dimCustomer"].columns) == 12
    assert tables["dimProduct"].count() == 2
    dates = tables["dimDate"]
    # The spread dates reach past the usual bounds, and the calendar follows them.
    last = fact.agg(F.max("OrderDate")).first()[0]
    usual = datetime.date(2024, 12, 31)
    assert dates.agg(F.min("Date"), F.max("Date")).first() == (
        datetime.date(2000, 1, 1), max(last, usual)
    )
    assert fact.join(dates, fact.OrderDate == dates.Date, "left_anti").count() == 0
    for name, key in [("dimCustomer", "CustomerIDKey"), ("dimProduct", "ProductIDKey")]:
        table = read_table(spark, f"{gold_root}/{name}")
        assert table.columns[0] == key
        assert sorted(row[0] for row in table.collect()) == list(range(table.count()))


def test_rerun_replaces_all(spark, bronze, tmp_path, database):
    roots = str(tmp_path / "silver"), str(tmp_path / "gold")
    for _ in range(2):
        tables = run_layers(spark, bronze, *roots, database=database)
    assert tables["factSales"].count() == 4
    assert tables["salesCustomer"].count() == 3


def test_options_of_the_silver_step(spark, bronze, tmp_path, database):
    silver = run_silver(
        spark,
        bronze,
        str(tmp_path / "silver"),
        database=database,
        spread=None,
        where={"salesOrderHeader": "OnlineOrderFlag", "salesProduct": F.col("Color") == "Red"},
    )
    assert [r.SalesOrderNumber for r in silver["salesOrderHeader"].collect()] == ["SO2"]
    assert silver["salesOrderHeader"].first().OrderDate == datetime.datetime(2008, 6, 1)
    assert silver["salesProduct"].count() == 1
    assert silver["salesCustomer"].count() == 3


def test_given_types_give_the_same_rows(spark, bronze, tmp_path, database):
    def rows(root, **options):
        silver = run_silver(
            spark, bronze, str(tmp_path / root), database=database, spread=None, **options
        )
        return {name: sorted(map(tuple, frame.collect()), key=str) for name, frame in silver.items()}

    assert rows("given", types=SILVER_TYPES) == rows("inferred")
    written = read_table(spark, str(tmp_path / "given/salesOrderHeader")).schema
    assert all(
        field.dataType.simpleString() == SILVER_TYPES.get(field.name, "string") for field in written
    )


def test_options_reach_both_steps(spark, bronze, tmp_path, database):
    tables = run_layers(
        spark,
        bronze,
        str(tmp_path / "silver"),
        str(tmp_path / "gold"),
        database=database,
        silver_options={"spread": "rand", "types": SILVER_TYPES},
        gold_options={"first_date": "2020-01-01", "last_date": "2020-01-31"},
    )
    assert tables["dimDate"].count() == 31
    assert tables["factSales"].agg(F.count("*"), F.sum("LineTotal")).first() == (4, 58.0)


def test_gold_as_written(spark, bronze, tmp_path, database):
    silver_root = str(tmp_path / "silver")
    run_silver(spark, bronze, silver_root, database=database)
    tables = run_gold(
        spark,
        silver_root,
        str(tmp_path / "gold"),
        database=database,
        mode="monotonic",
        first_date="2020-01-01",
        last_date="2020-12-31",
        as_written=True,
    )
    assert tables["dimDate"].count() == 366
    assert tables["dimProduct"].columns[1:] == tables["dimCustomer"].columns[1:]
    fact = tables["factSales"]
    assert len(fact.columns) == 25
    assert fact.count() == 6
    assert fact.where("SalesOrderID = 1").count() == 4
    assert fact.where("CustomerIDKey is null").count() == 1
    keys = {row[0] for row in tables["dimCustomer"].select("CustomerIDKey").collect()}
    used = {row[0] for row in fact.select("CustomerIDKey").collect()} - {None}
    assert used <= keys
