"""Synthetic retail tables of any size.

Every value is a function of the row number and a seed, so tables are built in
parallel, repeat exactly, and agree with each other (an order's price is its
product's price) without any lookup.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Default sizes, seed and value domains of the retail tables.
SEED = 100
NUM_PRODUCTS = 500
NUM_CUSTOMERS = 5000
NUM_ORDERS = 50000
CATEGORIES = {
    "Electronics": ["Laptop", "Mobile", "Tablet", "Camera", "Headphones"],
    "Furniture": ["Chair", "Table", "Sofa", "Bed"],
    "Fashion": ["Shirt", "Jeans", "Shoes", "Jacket"],
    "Groceries": ["Rice", "Oil", "Sugar", "Tea"],
}
BRANDS = ["Samsung", "Apple", "Sony", "LG", "Dell", "HP", "Nike", "Adidas"]
CITIES = [
    ("Chennai", "Tamil Nadu"),
    ("Bengaluru", "Karnataka"),
    ("Hyderabad", "Telangana"),
    ("Mumbai", "Maharashtra"),
    ("Pune", "Maharashtra"),
    ("Delhi", "Delhi"),
    ("Kolkata", "West Bengal"),
    ("Ahmedabad", "Gujarat"),
]
PAYMENT_METHODS = ["Cash", "Credit Card", "Debit Card", "UPI", "Net Banking"]
ORDER_STATUSES = ["Delivered", "Shipped", "Cancelled", "Returned"]
DISCOUNTS = [0, 5, 10, 15, 20]
GENDERS = ["Male", "Female"]
PRODUCT_STATUSES = ["Active", "Inactive"]
COUNTRY = "India"
# Ours: names are drawn from these instead of a name generator.
FIRST_NAMES = ["Asha", "Ravi", "Meena", "Arjun", "Divya", "Karan", "Latha", "Vijay"]
LAST_NAMES = ["Iyer", "Nair", "Patel", "Reddy", "Sharma", "Gupta", "Menon", "Bose"]


def _draw(key: Column, what: str, n: int, seed: int) -> Column:
    """A whole number in 0..n-1 that depends on key, purpose and seed only."""
    return F.pmod(F.xxhash64(key, F.lit(what), F.lit(seed)), F.lit(n))


def _pick(key: Column, what: str, values: Sequence[object], seed: int) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), _draw(key, what, len(values), seed).cast("int"))


def _cost_cents(product: Column, seed: int) -> Column:
    return F.lit(10_000) + _draw(product, "cost", 490_001, seed)


def _price(product: Column, seed: int) -> Column:
    markup = F.lit(1.10) + _draw(product, "markup", 4001, seed) / F.lit(10_000.0)
    return F.round(_cost_cents(product, seed) / F.lit(100.0) * markup, 2)


def products(spark: SparkSession, n: int = NUM_PRODUCTS, seed: int = SEED) -> DataFrame:
    key = F.col("ProductID")
    items = F.array(*[F.array(*[F.lit(i) for i in CATEGORIES[c]]) for c in CATEGORIES])
    category = _draw(key, "category", len(CATEGORIES), seed).cast("int")
    choices = F.get(items, category)
    item = F.pmod(F.xxhash64(key, F.lit("item"), F.lit(seed)), F.size(choices).cast("bigint"))
    return (
        spark.range(1, n + 1)
        .select(F.col("id").cast("int").alias("ProductID"))
        .select(
            key,
            F.get(choices, item.cast("int")).alias("ProductName"),
            F.get(F.array(*[F.lit(c) for c in CATEGORIES]), category).alias("Category"),
            _pick(key, "brand", BRANDS, seed).alias("Brand"),
            (_cost_cents(key, seed) / F.lit(100.0)).alias("CostPrice"),
            _price(key, seed).alias("SellingPrice"),
            _pick(key, "status", PRODUCT_STATUSES, seed).alias("Status"),
        )
    )


def customers(
    spark: SparkSession, as_of: date, n: int = NUM_CUSTOMERS, seed: int = SEED
) -> DataFrame:
    key = F.col("CustomerID")
    today = F.lit(as_of)
    first, last = _pick(key, "first", FIRST_NAMES, seed), _pick(key, "last", LAST_NAMES, seed)
    place = _draw(key, "place", len(CITIES), seed).cast("int")
    digits = F.lpad(_draw(key, "phone", 10**9, seed).cast("string"), 9, "0")
    birth = F.date_sub(today, (F.lit(18 * 366) + _draw(key, "birth", 42 * 365, seed)).cast("int"))
    registered = F.date_sub(today, (F.lit(31) + _draw(key, "since", 1000, seed)).cast("int"))
    updated = F.date_add(registered, _draw(key, "update", 31, seed).cast("int"))
    return (
        spark.range(1, n + 1)
        .select(F.col("id").cast("int").alias("CustomerID"))
        .select(
            key,
            F.concat_ws(" ", first, last).alias("CustomerName"),
            _pick(key, "gender", GENDERS, seed).alias("Gender"),
            F.concat(F.lower(first), F.lit("."), F.lower(last), key, F.lit("@gmail.com")).alias(
                "Email"
            ),
            F.concat(F.lit("9"), digits).alias("Phone"),
            birth.alias("DateOfBirth"),
            F.get(F.array(*[F.lit(c) for c, _ in CITIES]), place).alias("City"),
            F.get(F.array(*[F.lit(s) for _, s in CITIES]), place).alias("State"),
            F.lit(COUNTRY).alias("Country"),
            registered.cast("timestamp").alias("RegistrationDate"),
            updated.cast("timestamp").alias("LastUpdated"),
        )
    )


def orders(
    spark: SparkSession,
    as_of: date,
    n: int = NUM_ORDERS,
    n_customers: int = NUM_CUSTOMERS,
    n_products: int = NUM_PRODUCTS,
    seed: int = SEED,
) -> DataFrame:
    key = F.col("OrderID")
    product = (F.lit(1) + _draw(key, "product", n_products, seed)).cast("int")
    seconds = _draw(key, "time", 720 * 86_400, seed)
    ordered = F.timestamp_seconds(
        F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.lit(8 * 86_400) - seconds
    )
    total = F.col("Quantity") * F.col("UnitPrice") * (1 - F.col("Discount") / 100)
    shipped = F.timestamp_seconds(
        F.unix_timestamp("OrderDate") + (1 + _draw(key, "ship", 7, seed)) * 86_400
    )
    return (
        spark.range(1, n + 1)
        .select(F.col("id").cast("int").alias("OrderID"))
        .select(
            key,
            (F.lit(1) + _draw(key, "customer", n_customers, seed)).cast("int").alias("CustomerID"),
            product.alias("ProductID"),
            (F.lit(1) + _draw(key, "quantity", 10, seed)).cast("int").alias("Quantity"),
            _price(product, seed).alias("UnitPrice"),
            _pick(key, "discount", [float(d) for d in DISCOUNTS], seed).alias("Discount"),
            ordered.alias("OrderDate"),
            _pick(key, "payment", PAYMENT_METHODS, seed).alias("PaymentMethod"),
            _pick(key, "state", ORDER_STATUSES, seed).alias("OrderStatus"),
        )
        .withColumns({"TotalAmount": F.round(total, 2), "ShipDate": shipped})
        .select(
            "OrderID",
            "CustomerID",
            "ProductID",
            "Quantity",
            "UnitPrice",
            "Discount",
            "TotalAmount",
            "OrderDate",
            "ShipDate",
            "PaymentMethod",
            "OrderStatus",
        )
    )
