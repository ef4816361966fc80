"""Splitting one invoice value evenly over the items it bills."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.billing import share
from ledgerloom.functions.cleaning import split_list
from ledgerloom.operators.dedupe import keep_first, with_group_count
from ledgerloom.operators.skew import NONE_HOT, spread_left
from ledgerloom.session import settle


def allocate_unique(
    df: DataFrame,
    invoice: str,
    items: str,
    value: str,
    item_as: str = "codigo_veiculo",
    count_as: str = "qtd_veiculos_boleto",
    share_as: str = "valor_rateado",
) -> DataFrame:
    """Allocation for input with one row per invoice.

    Distinct items and their number are known inside the row, so neither the
    dedupe nor the count needs a shuffle.
    """
    distinct = F.array_distinct(F.filter(F.col(items), lambda item: item.isNotNull()))
    return (
        df.select(F.col(invoice), F.col(value), distinct.alias("__items"))
        .select(invoice, value, F.size("__items").cast("bigint").alias(count_as), F.explode("__items").alias(item_as))
        .select(invoice, item_as, count_as, share(F.col(value), F.col(count_as)).alias(share_as))
    )


def allocate_items(
    items: DataFrame,
    invoices: DataFrame,
    invoice: str,
    item: str,
    value: str,
    item_as: str = "codigo_veiculo",
    count_as: str = "qtd_veiculos_boleto",
    share_as: str = "valor_rateado",
    hot: DataFrame | None = NONE_HOT,
) -> DataFrame:
    """Allocation for items kept apart from their invoices: (invoice, item) rows, repeats allowed.

    Pairs are made distinct first, which spreads an invoice with very many items
    over all tasks, and counted with partial aggregation. Value and count meet at
    one row per invoice, and only then is the share brought to the items.
    """
    pairs = items.select(F.col(invoice).alias("__invoice"), F.col(item).alias(item_as))
    pairs = pairs.filter(F.col(item_as).isNotNull()).distinct()
    counts = pairs.groupBy("__invoice").agg(F.count(F.lit(1)).alias(count_as))
    values = invoices.select(F.col(invoice), F.col(value))
    shares = counts.join(values, counts["__invoice"] == values[invoice]).select(
        invoice, count_as, share(F.col(value), F.col(count_as)).alias(share_as)
    )
    extra = F.lit(True)
    if hot is not None:
        # Salts go by position, which is settled here, behind the shuffle of distinct().
        pairs = settle(pairs, "allocation-pairs")
        pairs, shares = spread_left(pairs, shares, "__invoice", invoice, hot)
        extra = pairs["__salt"] == shares["__right_salt"]
    joined = pairs.join(shares, (pairs["__invoice"] == shares[invoice]) & extra)
    return joined.select(invoice, item_as, count_as, share_as)


def allocate(
    df: DataFrame,
    invoice: str,
    items: str,
    value: str,
    order: list[str],
    item_as: str = "codigo_veiculo",
    count_as: str = "qtd_veiculos_boleto",
    share_as: str = "valor_rateado",
) -> DataFrame:
    """Allocation for rows with an item list each, where an invoice may occur in several rows.

    The first value of a repeated (invoice, item) wins.
    """
    exploded = df.select(invoice, value, *order, F.posexplode(items).alias("__pos", "__item"))
    # Settled, as it is read twice and ties in the order must not be settled differently each time.
    pairs = settle(keep_first(exploded.filter("__item is not null"), [invoice, "__item"], [*order, "__pos"]), "allocation")
    counted = with_group_count(pairs.select(invoice, "__item", value), [invoice], "__item", count_as)
    return counted.select(
        invoice, F.col("__item").alias(item_as), count_as, share(F.col(value), F.col(count_as)).alias(share_as)
    )


def stored_items(invoices: DataFrame, invoice: str, items: str, value: str) -> DataFrame:
    """Only what the allocation needs of stored invoices that have items; the filter reaches the scan."""
    return invoices.select(invoice, items, value).filter(F.col(items).isNotNull() & (F.col(items) != ""))


def allocate_from_text(invoices: DataFrame, invoice: str, items: str, value: str, separator: str = ",") -> DataFrame:
    """Rebuild the allocation from stored invoices whose items are delimited text."""
    stored = stored_items(invoices, invoice, items, value)
    return allocate_unique(stored.withColumn(items, split_list(F.col(items), separator)), invoice, items, value)
