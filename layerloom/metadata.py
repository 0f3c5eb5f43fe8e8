"""The metadata tables that drive the warehouse, and their default rows.

Metadata is small by nature (rows per table, column or rule), so it is held as
Python rows on the driver and stored as tables for editing.
"""

from __future__ import annotations

import json
from dataclasses import astuple, dataclass, field, fields
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from layerloom.context import TechnicalColumns
from layerloom.operators.rules import Rule

# Source types a table may have.
FILES, DATABASE, API = "ADLS", "AZURE_SQL", "API"
SOURCE_TYPES = (FILES, DATABASE, API)
TYPE1, TYPE2, NO_HISTORY = "TYPE1", "TYPE2", "NONE"
DIM, FACT = "DIM", "FACT"


@dataclass(frozen=True)
class TableConfig:
    table_name: str
    source_type: str
    source_name: str
    file_format: str
    target_file_format: str
    load_type: str
    primary_key: str  # several columns are separated by commas
    business_key: str
    scd_type: str
    watermark_column: str | None
    landing_folder: str
    bronze_folder: str
    silver_folder: str
    gold_object: str | None
    active_flag: str
    execution_order: int

    def __post_init__(self) -> None:
        if self.source_type not in SOURCE_TYPES:
            raise ValueError(f"{self.table_name}: unknown source type {self.source_type!r}")


@dataclass(frozen=True)
class DatatypeConfig:
    table_name: str
    column_name: str
    target_datatype: str


@dataclass(frozen=True)
class DqConfig:
    table_name: str
    column_name: str
    validation_rule: str
    severity: str
    # Arguments of the rule as a JSON object, e.g. its list of allowed values.
    arguments: str | None = None


@dataclass(frozen=True)
class WatermarkConfig:
    table_name: str
    watermark_column: str
    last_watermark: datetime | None


@dataclass(frozen=True)
class TechnicalConfig:
    config_name: str
    config_value: str


@dataclass(frozen=True)
class ScdConfig:
    table_name: str
    business_key: str
    scd_type: str


@dataclass(frozen=True)
class GoldConfig:
    gold_object: str
    source_table: str
    object_type: str


@dataclass(frozen=True)
class PublishConfig:
    enabled: bool
    table_name: str
    target_table: str


# Column types of each metadata table.
SCHEMAS = {
    "table_config": ", ".join(
        f"{f.name} {'int' if f.name == 'execution_order' else 'string'}"
        for f in fields(TableConfig)
    ),
    "datatype_config": "table_name string, column_name string, target_datatype string",
    "dq_config": "table_name string, column_name string, validation_rule string, "
    "severity string, arguments string",
    "watermark": "table_name string, watermark_column string, last_watermark timestamp",
    "technical_config": "config_name string, config_value string",
    "scd_config": "table_name string, business_key string, scd_type string",
    "gold_config": "gold_object string, source_table string, object_type string",
    "publish_config": "enabled boolean, table_name string, target_table string",
}

# The default rows of the metadata tables. The table format is
# ours (parquet), as are the fact's name and the exchange rate dimension, its key (the
# pair of currencies) and its watermark column, which says which of two rates is later.
TABLES = [
    TableConfig("products", FILES, "products", "csv", "parquet", "FULL", "ProductID", "ProductID",
                TYPE1, None, "products", "products", "products", "product_dim", "Y", 1),
    TableConfig("customers", FILES, "customers", "csv", "parquet", "INCREMENTAL", "CustomerID",
                "CustomerID", TYPE2, "LastUpdated", "customers", "customers", "customers",
                "customer_dim", "Y", 2),
    TableConfig("orders", FILES, "orders", "csv", "parquet", "INCREMENTAL", "OrderID", "OrderID",
                NO_HISTORY, "OrderDate", "orders", "orders", "orders", "fact_sales", "Y", 3),
    TableConfig("exchange_rates", API, "exchange_rates", "json", "parquet", "FULL",
                "BaseCurrency,TargetCurrency", "BaseCurrency,TargetCurrency", NO_HISTORY, "RateDate", "exchange_rates",
                "exchange_rates", "exchange_rates", "exchange_rate_dim", "Y", 4),
]
DATATYPES = [
    DatatypeConfig(*row)
    for row in [
        ("orders", "OrderID", "INT"),
        ("orders", "CustomerID", "INT"),
        ("orders", "ProductID", "INT"),
        ("orders", "StoreID", "INT"),
        ("orders", "OrderDate", "TIMESTAMP"),
        ("orders", "ShipDate", "TIMESTAMP"),
        ("orders", "Quantity", "INT"),
        ("orders", "UnitPrice", "DECIMAL(18,2)"),
        ("orders", "Discount", "DECIMAL(5,2)"),
        ("orders", "TotalAmount", "DECIMAL(18,2)"),
        ("products", "ProductID", "INT"),
        ("products", "ProductName", "STRING"),
        ("products", "Category", "STRING"),
        ("products", "SubCategory", "STRING"),
        ("products", "Brand", "STRING"),
        ("products", "UnitCost", "DECIMAL(18,2)"),
        ("products", "SellingPrice", "DECIMAL(18,2)"),
        ("products", "Status", "STRING"),
        ("customers", "CustomerID", "INT"),
        ("customers", "CustomerName", "STRING"),
        ("customers", "Email", "STRING"),
        ("customers", "Phone", "STRING"),
        ("customers", "Gender", "STRING"),
        ("customers", "DateOfBirth", "DATE"),
        ("customers", "City", "STRING"),
        ("customers", "State", "STRING"),
        ("customers", "Country", "STRING"),
        ("customers", "LastUpdated", "TIMESTAMP"),
        ("exchange_rates", "BaseCurrency", "STRING"),
        ("exchange_rates", "TargetCurrency", "STRING"),
        ("exchange_rates", "ExchangeRate", "DECIMAL(18,6)"),
        ("exchange_rates", "RateDate", "DATE"),
    ]
]
RULES = [
    DqConfig(*row)
    for row in [
        ("orders", "OrderID", "NOT_NULL", "ERROR"),
        ("orders", "CustomerID", "NOT_NULL", "ERROR"),
        ("orders", "ProductID", "NOT_NULL", "ERROR"),
        ("orders", "StoreID", "NOT_NULL", "ERROR"),
        ("orders", "Quantity", "POSITIVE_NUMBER", "ERROR"),
        ("orders", "UnitPrice", "POSITIVE_NUMBER", "ERROR"),
        ("orders", "Discount", "VALID_DISCOUNT", "ERROR"),
        ("orders", "OrderDate", "NOT_FUTURE_DATE", "ERROR"),
        ("orders", "ShipDate", "SHIP_AFTER_ORDER", "ERROR"),
        ("orders", "TotalAmount", "VALID_ORDER_TOTAL", "ERROR"),
        ("products", "ProductID", "NOT_NULL", "ERROR"),
        ("products", "ProductName", "NOT_EMPTY", "ERROR"),
        ("products", "Category", "VALID_CATEGORY", "ERROR"),
        ("products", "UnitCost", "POSITIVE_NUMBER", "ERROR"),
        ("products", "SellingPrice", "SELL_PRICE_GE_COST", "ERROR"),
        ("products", "Status", "VALID_PRODUCT_STATUS", "WARNING"),
        ("customers", "CustomerID", "NOT_NULL", "ERROR"),
        ("customers", "CustomerName", "NOT_EMPTY", "ERROR"),
        ("customers", "Email", "VALID_EMAIL", "ERROR"),
        ("customers", "Phone", "VALID_PHONE", "WARNING"),
        ("customers", "DateOfBirth", "VALID_DOB", "ERROR"),
        ("customers", "Country", "VALID_COUNTRY", "WARNING"),
        ("customers", "LastUpdated", "NOT_NULL", "ERROR"),
        ("exchange_rates", "BaseCurrency", "VALID_CURRENCY", "ERROR"),
        ("exchange_rates", "TargetCurrency", "VALID_CURRENCY", "ERROR"),
        ("exchange_rates", "ExchangeRate", "POSITIVE_NUMBER", "ERROR"),
        ("exchange_rates", "RateDate", "NOT_FUTURE_DATE", "ERROR"),
    ]
]
WATERMARKS = [WatermarkConfig("customers", "LastUpdated", None)]
SCD = [ScdConfig("customers", "CustomerID", TYPE2)]
GOLD = [
    GoldConfig("customer_dim", "customers", DIM),
    GoldConfig("product_dim", "products", DIM),
    GoldConfig("fact_sales", "orders", FACT),
]
# Ours: every gold table is published under its own name.
PUBLISH = [
    PublishConfig(True, name, name)
    for name in [
        "customer_dim",
        "product_dim",
        "exchange_rate_dim",
        "fact_sales",
        "sales_summary",
        "customer_sales_summary",
    ]
]


@dataclass(frozen=True)
class Metadata:
    """All control data of the warehouse."""

    tables: list[TableConfig] = field(default_factory=lambda: list(TABLES))
    datatypes: list[DatatypeConfig] = field(default_factory=lambda: list(DATATYPES))
    rules: list[DqConfig] = field(default_factory=lambda: list(RULES))
    watermarks: list[WatermarkConfig] = field(default_factory=lambda: list(WATERMARKS))
    scd: list[ScdConfig] = field(default_factory=lambda: list(SCD))
    gold: list[GoldConfig] = field(default_factory=lambda: list(GOLD))
    publish: list[PublishConfig] = field(default_factory=lambda: list(PUBLISH))
    technical: TechnicalColumns = field(default_factory=TechnicalColumns)

    def active_tables(self) -> list[TableConfig]:
        active = [t for t in self.tables if t.active_flag == "Y"]
        return sorted(active, key=lambda t: t.execution_order)

    def table(self, name: str) -> TableConfig:
        for config in self.tables:
            if config.table_name == name:
                return config
        raise KeyError(f"no table configuration for {name!r}")

    def types_of(self, table: str) -> dict[str, str]:
        return {d.column_name: d.target_datatype for d in self.datatypes if d.table_name == table}

    def rules_of(self, table: str) -> list[Rule]:
        return [
            Rule(r.column_name, r.validation_rule, r.severity, json.loads(r.arguments or "{}"))
            for r in self.rules
            if r.table_name == table
        ]

    def first_mark(self, table: str) -> datetime | None:
        """The configured starting mark, used before any load is recorded."""
        for w in self.watermarks:
            if w.table_name == table:
                return w.last_watermark
        return None

    def published(self) -> list[PublishConfig]:
        return [p for p in self.publish if p.enabled]

    def frames(self, spark: SparkSession) -> dict[str, DataFrame]:
        """Each metadata table as a DataFrame."""
        technical = [TechnicalConfig(k, v) for k, v in self.technical.to_config().items()]
        rows = {
            "table_config": self.tables,
            "datatype_config": self.datatypes,
            "dq_config": self.rules,
            "watermark": self.watermarks,
            "technical_config": technical,
            "scd_config": self.scd,
            "gold_config": self.gold,
            "publish_config": self.publish,
        }
        return {
            name: spark.createDataFrame([astuple(r) for r in rows[name]], SCHEMAS[name])
            for name in rows
        }

    @classmethod
    def from_frames(cls, frames: dict[str, DataFrame]) -> "Metadata":
        """Read the metadata tables back; each is collected once."""

        def rows(name: str, kind: type) -> list:
            names = [f.name for f in fields(kind)]
            return [kind(*r) for r in frames[name].select(*names).collect()]

        technical = {t.config_name: t.config_value for t in rows("technical_config", TechnicalConfig)}
        return cls(
            tables=rows("table_config", TableConfig),
            datatypes=rows("datatype_config", DatatypeConfig),
            rules=rows("dq_config", DqConfig),
            watermarks=rows("watermark", WatermarkConfig),
            scd=rows("scd_config", ScdConfig),
            gold=rows("gold_config", GoldConfig),
            publish=rows("publish_config", PublishConfig),
            technical=TechnicalColumns.from_config(technical),
        )
