"""From raw entity records to warehouse-ready tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import billing
from ledgerloom.functions.cleaning import (
    clean_date, clean_number, clean_text, field_of_each, first_of_list, join_list, to_flag,
)
from ledgerloom.operators.allocation import allocate_unique
from ledgerloom.operators.dedupe import dealt, keep_first, keep_last
from ledgerloom.operators.lookup import lookup_join
from ledgerloom.operators.shaping import drop, normalise_names, null_where, rename, require
from ledgerloom.plans import entities as E


def conform(df: DataFrame, entity: E.Entity, order: Sequence[str], last_of_repeats: bool = False) -> DataFrame:
    """Apply an entity's column rules, keep the first row per key, drop empty rows.

    ``order`` names the columns that give the ingest order; they are not part of
    the result. Only the key is cleaned before the dedupe; the other rules are
    applied once to the rows that stay. With ``last_of_repeats`` only the last of
    the records with the same raw key takes part, found in the same shuffle.
    """
    df = drop(rename(normalise_names(df), entity.renamed), entity.dropped)
    require(df, [*entity.text, *entity.days, *entity.numbers, *order])
    # The order columns are set aside first: one of them may be cleaned as well.
    ranked = {f"__order_{i}": F.col(name) for i, name in enumerate(order)}
    internal = [name for name in order if name.startswith("__")]
    rules = {name: clean_text(F.col(name)) for name in entity.text}
    typed = {name: clean_date(F.col(name)) for name in entity.days}
    typed |= {name: clean_number(F.col(name), kind) for name, kind in entity.numbers.items()}
    keyed = dealt(df.withColumns({**ranked, "__key": rules[entity.key]}), ["__key"])
    if last_of_repeats:
        keyed = keep_last(keyed, ["__key", entity.key], list(ranked))
    first = keep_first(keyed, ["__key"], list(ranked))
    # A row is empty if it is so after cleaning. Said of the raw columns, as far as these decide it, the filter does
    # not hold every rule again.
    plain = [name for name in df.columns if name not in typed and name not in internal and name != entity.key]
    filled = F.col("__key").isNotNull()
    for value in [*(F.col(name) for name in plain), *typed.values()]:
        filled = filled | value.isNotNull()
    rules |= typed
    rules[entity.key] = F.col("__key")
    return first.filter(filled).withColumns(rules).drop(*ranked, *internal, "__key")


def transform_customers(raw: DataFrame, statuses: DataFrame, reference: date, order: Sequence[str]) -> DataFrame:
    """Customers with the description of their status and their age.

    ``statuses`` holds (codigo_situacao, descricao_situacao), one row per code.
    """
    lookup = statuses.select("codigo_situacao", "descricao_situacao")
    return (
        lookup_join(conform(raw, E.CUSTOMERS, order), lookup, "codigo_situacao")
        .withColumn("idade", billing.age_years(F.col("data_nascimento"), reference))
    )


def transform_vehicles(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    return conform(raw, E.VEHICLES, order)


def transform_volunteers(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """Volunteers with the codes of their cooperatives as text."""
    raw = normalise_names(raw)
    codes = join_list(field_of_each(F.col("cooperativas"), "codigo_cooperativa"))
    return conform(raw.withColumn("cooperativas", codes), E.VOLUNTEERS, order)


def transform_cooperatives(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    return conform(raw, E.COOPERATIVES, order)


def transform_regionals(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    return conform(raw, E.REGIONALS, order)


def transform_statuses(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """Status list of customers and vehicles, with whether the source still uses a status."""
    in_use = to_flag(F.col("situacao"), E.STATUS_IN_USE)
    return conform(normalise_names(raw).withColumn("situacao_ativa", in_use).drop("situacao"), E.STATUSES, order)


def transform_invoice_statuses(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """Status list of invoices with its two business flags."""
    flags = {name: to_flag(F.col(name), E.YES_WORDS) for name in ("considerado_inadimplencia", "pago")}
    return conform(normalise_names(raw).withColumns(flags), E.INVOICE_STATUSES, order)


def _unwrap(raw: DataFrame) -> DataFrame:
    raw = normalise_names(raw)
    is_list = raw.schema["beneficiario"].dataType.typeName() == "array"
    return raw.withColumn("beneficiario", first_of_list(F.col("beneficiario"))) if is_list else raw


def apply_invoice_rules(clean: DataFrame, reference: date) -> DataFrame:
    """Aging and reconciliation columns; a paid invoice has no overdue days."""
    days = null_where(billing.days_overdue(F.col("data_vencimento"), reference), F.col("pago") == billing.PAID_MARK)
    billed, paid = F.col("valor_boleto"), F.col("valor_pagamento")
    return clean.withColumn("dias_em_atraso", days).withColumns(
        {
            "faixa_atraso": billing.aging_bucket(F.col("dias_em_atraso")),
            "status_pagamento": billing.payment_status(F.col("pago"), billed, paid),
            "diferenca_pagamento": billing.payment_difference(billed, paid),
        }
    )


def clean_invoices(raw: DataFrame, order: Sequence[str], last_of_repeats: bool = False) -> DataFrame:
    """Invoices cleaned and one per key, their vehicles still a list."""
    return conform(_unwrap(raw), E.INVOICES, order, last_of_repeats)


def invoice_tables(clean: DataFrame, reference: date) -> tuple[DataFrame, DataFrame]:
    """Invoices with their rules applied, and the allocation of each to its vehicles.

    One row per invoice is left after the clean-up, so the allocation needs no
    shuffle of its own. Vehicle codes are cleaned as those of the dimension are, so the two join.
    """
    codes = clean.withColumn("veiculo", F.transform(F.col("veiculo").cast("array<string>"), clean_text))
    bridge = allocate_unique(codes, "codigo_boleto", "veiculo", "valor_boleto")
    return apply_invoice_rules(clean.withColumn("veiculo", join_list(F.col("veiculo"))), reference), bridge


def transform_invoices(raw: DataFrame, reference: date, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The invoice table and the bridge from raw records."""
    return invoice_tables(clean_invoices(raw, order), reference)


def transform_delinquency(raw: DataFrame, reference: date, order: Sequence[str]) -> DataFrame:
    """Snapshot of the open invoices on the reference day; paid rows keep their days."""
    clean = conform(_unwrap(raw).withColumn("veiculo", join_list(F.col("veiculo"))), E.INVOICES, order)
    dated = clean.withColumns(
        {
            "dt_referencia": F.lit(reference),
            "dias_em_atraso": billing.days_overdue(F.col("data_vencimento"), reference),
        }
    )
    return dated.withColumn("faixa_atraso", billing.aging_bucket(F.col("dias_em_atraso")))
