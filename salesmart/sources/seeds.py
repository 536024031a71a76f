"""The starting dimensions of the twelve-store coffee chain."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from salesmart.operators import dims as dim_ops

# Store id, site, city, region, owner.
STORES = [
    ("S01", "Grafton St", "Dublin", "Leinster", "Murphy Catering Ltd"),
    ("S02", "Dundrum", "Dublin", "Leinster", "Murphy Catering Ltd"),
    ("S03", "Cork City", "Cork", "Munster", "O'Brien Foods Ltd"),
    ("S04", "Mahon Point", "Cork", "Munster", "O'Brien Foods Ltd"),
    ("S05", "Galway", "Galway", "Connacht", "Walsh Hospitality"),
    ("S06", "Eyre Square", "Galway", "Connacht", "Walsh Hospitality"),
    ("S07", "Limerick", "Limerick", "Munster", "Ryan Group"),
    ("S08", "Waterford", "Waterford", "Munster", "Ryan Group"),
    ("S09", "Kilkenny", "Kilkenny", "Leinster", "Brennan Retail"),
    ("S10", "Drogheda", "Drogheda", "Leinster", "Brennan Retail"),
    ("S11", "Sligo", "Sligo", "Connacht", "Kelly Ventures"),
    ("S12", "Athlone", "Athlone", "Leinster", "Kelly Ventures"),
]

# Sku, name, category, catalogue price.
PRODUCTS = [
    ("HOT001", "Espresso", "Hot Drinks", "2.50"),
    ("HOT002", "Americano", "Hot Drinks", "3.00"),
    ("HOT003", "Flat White", "Hot Drinks", "3.50"),
    ("HOT004", "Cappuccino", "Hot Drinks", "3.50"),
    ("HOT005", "Latte", "Hot Drinks", "3.80"),
    ("HOT006", "Hot Chocolate", "Hot Drinks", "3.80"),
    ("COL001", "Iced Latte", "Cold Drinks", "4.20"),
    ("COL002", "Iced Americano", "Cold Drinks", "3.80"),
    ("COL003", "Cold Brew", "Cold Drinks", "4.50"),
    ("COL004", "Sparkling Water", "Cold Drinks", "1.80"),
    ("FOD001", "Butter Croissant", "Food", "2.80"),
    ("FOD002", "Blueberry Muffin", "Food", "3.20"),
    ("FOD003", "Chicken Wrap", "Food", "6.50"),
    ("FOD004", "Ham & Cheese Toastie", "Food", "5.80"),
    ("FOD005", "Banana Bread", "Food", "3.00"),
    ("MER001", "Branded Mug", "Merch", "12.00"),
    ("MER002", "Reusable Cup", "Merch", "8.00"),
]

# Payment methods in key order.
PAYMENT_METHODS = ["Card", "Cash", "Contactless", "Apple Pay", "Google Pay"]

# Stores that do not send UTF-8.
ENCODINGS = {"S09": "UTF-16"}


def stores(spark: SparkSession, brand: str) -> DataFrame:
    """Store names are the brand followed by the site."""
    rows = [(key, sid, f"{brand} {site}", *rest) for key, (sid, site, *rest) in enumerate(STORES, 1)]
    columns = "store_key int, store_id string, store_name string, city string, region string, franchise_owner string"
    return dim_ops.build_store(spark.createDataFrame(rows, columns))


def products(spark: SparkSession) -> DataFrame:
    rows = [(key, sku, name, kind, Decimal(price)) for key, (sku, name, kind, price) in enumerate(PRODUCTS, 1)]
    columns = "product_key int, product_sku string, product_name string, category string, standard_price decimal(10,2)"
    return dim_ops.build_product(spark.createDataFrame(rows, columns))


def payments(spark: SparkSession) -> DataFrame:
    return dim_ops.build_payment(spark.createDataFrame(list(enumerate(PAYMENT_METHODS, 1)), "payment_key int, payment_method string"))
