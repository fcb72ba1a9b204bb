"""The sales star: orders and opportunities with the names behind their keys.

A dimension is broadcast if its files are small. Beyond that both sides shuffle on the key,
and adaptive execution splits a key that holds much of the orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.operators.sizes import broadcast_if_small


def order_history(
    orders: DataFrame, customers: DataFrame, products: DataFrame, include_city: bool = False
) -> DataFrame:
    """Every order column, then customer name, city if wanted, `customer_state` and product name."""
    city = [F.col("city")] if include_city else []
    who = customers.select("customerid", "customername", *city, F.col("state").alias("customer_state"))
    what = products.select("productid", "productname")
    names = ["customername", *(["city"] if include_city else []), "customer_state", "productname"]
    return (
        orders.join(broadcast_if_small(who), "customerid")
        .join(broadcast_if_small(what), "productid")
        .select(*orders.columns, *names)
    )


def opportunity_history(opportunities: DataFrame, customers: DataFrame) -> DataFrame:
    """Every opportunity column, then customer name and `customer_state`."""
    who = customers.select("customerid", "customername", F.col("state").alias("customer_state"))
    return opportunities.join(broadcast_if_small(who), "customerid").select(
        *opportunities.columns, "customername", "customer_state"
    )
