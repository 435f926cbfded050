"""Canonical schemas and per-table settings."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# One record of a partitioned log; the same columns the Kafka source gives.  Key and value are bytes.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
    ]
)

SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("db", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("commit_lsn", T.StringType()),
        T.StructField("connector", T.StringType()),
    ]
)

SIGNAL_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("data-collections", T.ArrayType(T.StringType())),
                    T.StructField("type", T.StringType()),
                    T.StructField("additional-condition", T.StringType()),
                ]
            ),
        ),
    ]
)

USER_EVENT_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("user_id", "name", "email", "action", "timestamp")
    ]
)


def envelope_schema(row: T.StructType) -> T.StructType:
    """The before/after envelope around row images of type ``row``."""
    return T.StructType(
        [
            T.StructField("before", row),
            T.StructField("after", row),
            T.StructField("source", SOURCE_SCHEMA),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )


@dataclass(frozen=True)
class TableSpec:
    """What the display and decimal operators need to know about a table."""

    name: str
    pk: tuple[str, ...]
    display: tuple[str, ...] = ()
    decimal_scales: dict[str, int] = field(default_factory=dict)


# Money columns and their scales, for tables without settings.
MONEY_SCALES = {
    "StandardCost": 4,
    "ListPrice": 4,
    "UnitPrice": 4,
    "UnitPriceDiscount": 4,
    "LineTotal": 6,
    "SubTotal": 4,
    "TaxAmt": 4,
    "Freight": 4,
    "TotalDue": 4,
}

# The captured tables, their keys and the columns shown for them.
CAPTURED_TABLES = {
    "Person": TableSpec(
        "Person",
        ("BusinessEntityID",),
        ("BusinessEntityID", "PersonType", "FirstName", "LastName", "EmailPromotion"),
    ),
    "Customer": TableSpec(
        "Customer",
        ("CustomerID",),
        ("CustomerID", "PersonID", "StoreID", "TerritoryID", "AccountNumber"),
    ),
    "SalesOrderHeader": TableSpec(
        "SalesOrderHeader",
        ("SalesOrderID",),
        ("SalesOrderID", "OrderDate", "Status", "CustomerID", "TotalDue", "SalesOrderNumber"),
        {"SubTotal": 4, "TaxAmt": 4, "Freight": 4, "TotalDue": 4},
    ),
    "SalesOrderDetail": TableSpec(
        "SalesOrderDetail",
        ("SalesOrderID", "SalesOrderDetailID"),
        ("SalesOrderID", "SalesOrderDetailID", "ProductID", "OrderQty", "UnitPrice", "LineTotal"),
        {"UnitPrice": 4, "UnitPriceDiscount": 4, "LineTotal": 6},
    ),
    "Product": TableSpec(
        "Product",
        ("ProductID",),
        ("ProductID", "Name", "ProductNumber", "Color", "StandardCost", "ListPrice"),
        {"StandardCost": 4, "ListPrice": 4},
    ),
}
