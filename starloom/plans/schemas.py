"""Column contracts of the two star models."""

from __future__ import annotations

from pyspark.sql import types as T

FACT = "FactCustomSales"
DIMENSIONS = ("DimCustomer", "DimProduct", "DimGeography", "DimDate")

# Table names, column names, their order and types are what readers of the
# warehouse expect. "{id}" is the type of keys and source ids: int by contract; use bigint for
# tables beyond 2^31 rows (with int such a value raises, it is never cut).
WIDE = {
    "DimCustomer": (
        "CustomerKey {id}, CustomerID {id}, PersonID {id}, StoreID {id}, TerritoryID int, "
        "AccountNumber string, Name string, EmailPromotion boolean, PhoneNumber string, "
        "ModifiedDate date"
    ),
    "DimProduct": (
        "ProductKey {id}, ProductID {id}, Name string, ProductNumber string, "
        "MakeFlag boolean, FinishedGoodsFlag boolean, Color string, SafetyStockLevel int, "
        "ReorderPoint int, StandardCost decimal(10,4), ListPrice decimal(10,4), Size string, "
        "SizeUnitMeasureCode string, Weight decimal(10,2), WeightUnitMeasureCode string, "
        "DaysToManufacture int, ProductLine string, Class string, Style string, "
        "ProductCategoryName string, ProductSubcategoryName string, ModifiedDate date"
    ),
    "DimGeography": (
        "GeographyKey {id}, AddressID {id}, AddressLine1 string, AddressLine2 string, "
        "City string, StateProvinceCode string, StateProvinceName string, "
        "CountryRegionCode string, CountryRegionName string, PostalCode string, "
        "ModifiedDate date"
    ),
    "DimDate": (
        "DateKey int, FullDateAlternateKey date, DayNumberOfMonth int, DayNameOfWeek string, "
        "DayNumberOfWeek int, DayNumberOfYear int, WeekNumberOfYear int, "
        "MonthNumberOfYear int, MonthName string, QuarterNumberOfYear int, "
        "QuarterName string, CalendarYear int, CalendarSemester string, FiscalQuarter int, "
        "FiscalYear int, FiscalSemester string, ModifiedDate date"
    ),
    "FactCustomSales": (
        "CustomerKey {id}, ProductKey {id}, GeographyKey {id}, DateKey int, "
        "SalesOrderID {id}, SalesOrderDetailID {id}, OrderQty int, UnitPrice decimal(10,4), "
        "UnitPriceDiscount decimal(10,4), LineTotal decimal(10,4), OrderDate date, "
        "DueDate date, ShipDate date, OnlineOrderFlag boolean, SalesOrderNumber string, "
        "CarrierTrackingNumber string, ModifiedDate date"
    ),
}
NARROW = {
    "DimCustomer": (
        "CustomerKey {id}, FirstName string, LastName string, EmailAddress string, "
        "CustomerType string"
    ),
    "DimProduct": (
        "ProductKey {id}, ProductName string, ProductNumber string, ProductCategory string, "
        "ProductSubcategory string"
    ),
    "DimGeography": (
        "GeographyKey {id}, City string, StateProvince string, CountryRegion string, "
        "PostalCode string"
    ),
    "DimDate": "DateKey int, FullDate date, Year int, Month int, MonthName string, Quarter int",
    "FactCustomSales": (
        "CustomerKey {id}, ProductKey {id}, GeographyKey {id}, DateKey int, "
        "OrderQuantity smallint, SalesAmount decimal(19,4), UnitPrice decimal(19,4)"
    ),
}
MODELS = {"wide": WIDE, "narrow": NARROW}

# Columns a row of the wide star must have to be kept.
REQUIRED = {
    "DimCustomer": ["CustomerKey", "AccountNumber", "Name", "ModifiedDate"],
    "DimProduct": [
        "ProductKey", "ProductID", "Name", "ProductNumber", "StandardCost", "ListPrice",
        "ModifiedDate",
    ],
    "DimGeography": [
        "GeographyKey", "AddressID", "AddressLine1", "City", "PostalCode", "ModifiedDate",
    ],
    "DimDate": ["DateKey", "FullDateAlternateKey", "CalendarYear"],
    "FactCustomSales": [
        "CustomerKey", "ProductKey", "GeographyKey", "DateKey", "SalesOrderID",
        "SalesOrderDetailID", "OrderQty", "UnitPrice", "LineTotal", "OrderDate",
    ],
}

# Rules declared for the narrow star's tables.
PRIMARY_KEYS = {
    "DimCustomer": ["CustomerKey"],
    "DimProduct": ["ProductKey"],
    "DimGeography": ["GeographyKey"],
    "DimDate": ["DateKey"],
    "FactCustomSales": ["CustomerKey", "ProductKey", "GeographyKey", "DateKey"],
}
FOREIGN_KEYS = {
    "FactCustomSales": {
        "CustomerKey": "DimCustomer",
        "ProductKey": "DimProduct",
        "GeographyKey": "DimGeography",
        "DateKey": "DimDate",
    }
}
MAX_LENGTHS = {
    "DimCustomer": {"FirstName": 50, "LastName": 50, "EmailAddress": 50, "CustomerType": 15},
    "DimProduct": {
        "ProductName": 100, "ProductNumber": 25, "ProductCategory": 50, "ProductSubcategory": 50,
    },
    "DimGeography": {"City": 30, "StateProvince": 50, "CountryRegion": 50, "PostalCode": 15},
    "DimDate": {"MonthName": 10},
}
# Columns readers filter on: files are sorted by them so that row groups can be skipped.
LOOKUP_COLUMNS = {
    "DimCustomer": ["LastName", "FirstName", "EmailAddress"],
    "DimProduct": ["ProductCategory", "ProductSubcategory", "ProductName"],
    "DimGeography": ["CountryRegion", "StateProvince", "City"],
    "DimDate": ["FullDate", "Year", "Month", "Quarter"],
    "FactCustomSales": ["DateKey", "CustomerKey", "ProductKey", "GeographyKey"],
}


def table_schema(model: str, table: str, ids: str = "int") -> T.StructType:
    return T.StructType.fromDDL(MODELS[model][table].format(id=ids))
