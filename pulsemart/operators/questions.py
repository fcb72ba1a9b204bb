"""Business questions asked in words, as named queries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.constants import STATE_CODES
from pulsemart.functions.columns import total
from pulsemart.operators.sizes import broadcast_if_small


def state_code(spoken: str, codes: Mapping[str, str] = STATE_CODES) -> str | None:
    """The code for a state's name or code as spoken; None for a place not among them."""
    said = spoken.strip().casefold()
    for name, code in codes.items():
        if said in (name.casefold(), code.casefold()):
            return code
    return None


def in_state(column: str, spoken: str, codes: Mapping[str, str] = STATE_CODES) -> Column:
    """Whether a row is in the state asked about; an unknown place matches no row.

    The lookup is a handful of fixed pairs, so it is settled before the query is built and
    the scan receives a plain equality.
    """
    code = state_code(spoken, codes)
    return F.lit(False) if code is None else F.col(column) == code


def customers_in_state(
    customers: DataFrame, spoken: str, codes: Mapping[str, str] = STATE_CODES
) -> DataFrame:
    return customers.where(in_state("state", spoken, codes)).agg(
        F.count(F.lit(1)).alias("customers")
    )


def list_customers_in_state(
    customers: DataFrame, spoken: str, codes: Mapping[str, str] = STATE_CODES
) -> DataFrame:
    """The rows behind the count."""
    return customers.where(in_state("state", spoken, codes)).orderBy("customername", "customerid")


def revenue_by_rep_in_state(
    orders: DataFrame,
    customers: DataFrame,
    spoken: str,
    codes: Mapping[str, str] = STATE_CODES,
    decimals: int | None = None,
) -> DataFrame:
    """Revenue from a state's customers per sales rep."""
    there = customers.where(in_state("state", spoken, codes)).select("customerid")
    return (
        orders.join(broadcast_if_small(there), "customerid")
        .groupBy("salesrep")
        .agg(total("orderamt", decimals).alias("revenue"))
    )


def top_rep_in_state(
    orders: DataFrame,
    customers: DataFrame,
    spoken: str,
    codes: Mapping[str, str] = STATE_CODES,
    decimals: int | None = None,
) -> DataFrame:
    """The rep with the most revenue there; equal revenue goes to the first name."""
    by_rep = revenue_by_rep_in_state(orders, customers, spoken, codes, decimals)
    return by_rep.orderBy(F.col("revenue").desc(), "salesrep").limit(1)
