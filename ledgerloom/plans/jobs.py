"""Load jobs: what happens once a day, once at the start, and in which order."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions.cleaning import clean_date, clean_text, split_list
from ledgerloom.operators import checks, scd2
from ledgerloom.operators.allocation import allocate_from_text
from ledgerloom.operators.dedupe import in_tasks
from ledgerloom.operators.skew import hot_keys
from ledgerloom.operators.temporal import dimension_versions, point_in_time_key
from ledgerloom.operators.upsert import audit_columns
from ledgerloom.operators.views import create_views
from ledgerloom.plans import entities as E, transforms as T
from ledgerloom.plans.warehouse import Warehouse
from ledgerloom.sources.landed import INGEST_ORDER
from ledgerloom.sources.windows import incremental_windows, merge_windows
from ledgerloom.streaming.landing import load_new_files

FACTS, BRIDGE, SNAPSHOT = "fact_invoices", "bridge_invoices_vehicles", "fact_delinquency_snapshot"
FACT_KEYS, BRIDGE_KEYS, SNAPSHOT_KEYS = ["codigo_boleto"], ["codigo_boleto", "codigo_veiculo"], ["codigo_boleto", "dt_referencia"]
CREATED_ONCE = ["criado_em"]
PER_INVOICE = ["invoices", "delinquency"]


@dataclass(frozen=True)
class Run:
    """The day and moment a run stands for; passed in, so that a rerun gives the same result."""

    reference: date
    now: datetime


def _current_count(warehouse: Warehouse, table: str, current_only: bool) -> int:
    state = warehouse.read_or_none(table)
    if state is None:
        return 0
    if current_only:
        slices = warehouse.read_slices(table)
        state = state.filter("vigente") if slices is None else slices.filter(F.col(scd2.SLICE) == scd2.OPEN)
    return checks.row_count(state).first()[0]


def load_simple_dimension(warehouse: Warehouse, entity: str, batch: DataFrame, run: Run) -> DataFrame | None:
    """Guarded upsert of one dimension; returns the code-list changes where there is a list."""
    table, key = E.SIMPLE_DIMENSIONS[entity]
    known = warehouse.read_or_none(table)
    arrived = checks.refuse_repeated_keys(batch, [key], entity)
    checks.refuse_abnormal_drop(arrived, _current_count(warehouse, table, False), entity)
    changes = None
    if entity in E.CODE_LISTS and known is not None:
        changes = _coverage(warehouse, entity, known, batch, key)
    warehouse.upsert(table, audit_columns(batch, run.now, run.reference), [key], CREATED_ONCE)
    return changes


def _coverage(warehouse: Warehouse, entity: str, known: DataFrame, batch: DataFrame, key: str) -> DataFrame | None:
    """Changes of a code list. It only informs, so its failure is told and does not stop the load."""
    try:
        return warehouse.land(checks.coverage_diff(known, batch, key, E.CODE_LISTS[entity]), f"{entity}-changes")
    except Exception as error:
        warnings.warn(f"codes of '{entity}' could not be compared: {error}", stacklevel=2)
        return None


def load_versioned_dimension(warehouse: Warehouse, entity: str, batch: DataFrame, run: Run) -> None:
    """Guarded Type 2 load of one dimension."""
    table, key, surrogate, monitored = E.VERSIONED_DIMENSIONS[entity]
    arrived = checks.refuse_repeated_keys(batch, [key], entity, nulls=True)
    checks.refuse_abnormal_drop(arrived, _current_count(warehouse, table, True), entity)
    apply_versions(warehouse, table, batch, key, surrogate, monitored, run)


def apply_versions(
    warehouse: Warehouse, table: str, batch: DataFrame, key: str, surrogate: str, monitored: Sequence[str], run: Run
) -> None:
    """Type 2 load of a table of versions. Closed versions are left as they are, in files of the day they ended on.

    A table that an earlier release keeps in one piece is rewritten whole, as before.
    """
    known, stored = warehouse.read_or_none(table), warehouse.read_slices(table)
    if known is None:
        first = scd2.with_slice(scd2.first_versions(batch, key, surrogate, run.now))
        warehouse.replace_slices(table, warehouse.land(first, table), scd2.SLICE, [surrogate])
    elif stored is None:
        warehouse.replace(table, scd2.apply_batch(known, batch, key, monitored, run.reference, surrogate, run.now))
    else:
        changes = scd2.apply_to_slices(stored, batch, key, monitored, run.reference, surrogate, run.now)
        if changes.closed is not None:
            landed = warehouse.land(changes.closed, table)
            warehouse.replace_slices(table, landed, scd2.SLICE, [surrogate], changes.closed_slices)
        warehouse.replace_slices(table, changes.opened, scd2.SLICE, [surrogate], [scd2.OPEN])


def _together(tasks: Mapping[str, Callable[[], object]]) -> tuple[dict[str, object], dict[str, Exception]]:
    """Run independent Spark actions at the same time, so that small tables do not leave the cluster idle."""
    results, failures = {}, {}
    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        pending = {name: pool.submit(task) for name, task in tasks.items()}
        for name, future in pending.items():
            try:
                results[name] = future.result()
            except Exception as error:
                failures[name] = error
    return results, failures


def load_dimension(warehouse: Warehouse, entity: str, batch: DataFrame | None, run: Run) -> DataFrame | None:
    """Guarded load of one dimension of either kind."""
    if batch is None:
        raise checks.LoadRefused("no processed data")
    if entity in E.SIMPLE_DIMENSIONS:
        return load_simple_dimension(warehouse, entity, batch, run)
    return load_versioned_dimension(warehouse, entity, batch, run)


def load_dimensions(warehouse: Warehouse, batches: Mapping[str, DataFrame | None], run: Run) -> dict[str, DataFrame]:
    """Load all dimensions. One failing entity does not stop the others but fails the job."""
    return _each_dimension(lambda entity: load_dimension(warehouse, entity, batches.get(entity), run))


def _each_dimension(load: Callable[[str], DataFrame | None]) -> dict[str, DataFrame]:
    entities = [*E.SIMPLE_DIMENSIONS, *E.VERSIONED_DIMENSIONS]
    changes, failures = _together({entity: partial(load, entity) for entity in entities})
    if failures:
        detail = {entity: str(error) for entity, error in failures.items()}
        raise checks.LoadRefused(f"dimension load failed for {sorted(failures)}: {detail}")
    return {entity: found for entity, found in changes.items() if found is not None}


def _with_customer_key(warehouse: Warehouse, invoices: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Invoices with the customer version of their emission day, and the keys of all of them as a landed narrow frame.

    Versions are looked up for keys, customers and days alone. The load checks keys and finds the partitions it touches
    in that frame, and wide rows meet it by key, where they are sent anyway, so they neither go by customer nor are
    written in between. As the load refuses null and repeated keys, no row is lost or repeated. Without a dimension
    there is no join and nothing to land.
    """
    dim = warehouse.read_or_none("dim_customers")
    if dim is None:
        return point_in_time_key(invoices, None, "codigo_associado", "data_emissao", "codigo_associado", "sk_customer"), None
    versions = dimension_versions(dim, "codigo_associado", "sk_customer")
    hot = hot_keys(invoices, "codigo_associado")
    narrow = invoices.select(*keys, "codigo_associado", "data_emissao")
    keyed = point_in_time_key(narrow, versions, "codigo_associado", "data_emissao", "codigo_associado", "sk_customer", hot)
    keyed = warehouse.land(keyed.select(*keys, "sk_customer"), "keyed")
    wide = in_tasks(invoices, keys, keyed.count())
    return wide.join(keyed, list(keys), "left").select(*(wide[f"`{name}`"] for name in wide.columns), keyed["sk_customer"]), keyed


def load_facts(warehouse: Warehouse, invoices: DataFrame, run: Run) -> None:
    """Invoices with the customer version of their emission day, upserted."""
    batch, keyed = _with_customer_key(warehouse, invoices, FACT_KEYS)
    warehouse.upsert_ranges(FACTS, audit_columns(batch, run.now, run.reference), FACT_KEYS, CREATED_ONCE, keyed=keyed)
    warehouse.release(keyed)


def load_bridge(warehouse: Warehouse, bridge: DataFrame, run: Run, whole_parents: bool = False) -> None:
    """Allocation rows, upserted by invoice and vehicle."""
    stamped = audit_columns(bridge, run.now, run.reference)
    warehouse.upsert_ranges(BRIDGE, stamped, BRIDGE_KEYS, CREATED_ONCE, whole_parents)


def load_snapshot(warehouse: Warehouse, delinquency: DataFrame, run: Run) -> None:
    """The day's open invoices in place of whatever that day held before."""
    batch, keyed = _with_customer_key(warehouse, delinquency, SNAPSHOT_KEYS)
    stamped = batch.withColumn("criado_em", F.lit(run.now))
    warehouse.replace_slices(SNAPSHOT, stamped, "dt_referencia", SNAPSHOT_KEYS, slices=[run.reference], keyed=keyed)
    warehouse.release(keyed)


def backfill_bridge(warehouse: Warehouse, run: Run) -> None:
    """Rebuild the bridge from the vehicles stored as text with each invoice."""
    codes = F.array_join(F.transform(split_list(F.col("veiculo")), clean_text), ",")
    facts = warehouse.read(FACTS).withColumn("veiculo", codes)
    rebuilt = warehouse.land(allocate_from_text(facts, "codigo_boleto", "veiculo", "valor_boleto"), "bridge")
    load_bridge(warehouse, rebuilt, run)
    warehouse.release(rebuilt)


def initial_load(
    warehouse: Warehouse, history: DataFrame, run: Run, order: Sequence[str], status: DataFrame | None = None
) -> None:
    """All months at once: the last record per invoice wins, then the same rules and loads as every day.

    ``status`` holds slice and error of each month's extraction; nothing is loaded if one failed.
    """
    if status is not None:
        checks.refuse_incomplete(status, "slice", "error", "invoices")
    _load_history(warehouse, history, run, order)


def initial_load_by_slice(
    warehouse: Warehouse,
    history: DataFrame,
    slice_column: str,
    run: Run,
    order: Sequence[str],
    status: DataFrame | None = None,
    ledger: str = "initial",
) -> int:
    """As ``initial_load``, slice by slice (a month of extraction, say); returns how many slices were loaded.

    The state is that of the last record of each invoice by slice, then order. An invoice is loaded with its last slice
    only, so no slice undoes what another did, and each reads its own records. Slices that are done are listed in a
    table beside the warehouse's: a run that stopped goes on with the first that is not, and the slice it stopped in
    is loaded again, to the same state. The history must be complete when the first run begins.
    """
    if status is not None:
        checks.refuse_incomplete(status, "slice", "error", "invoices")
    key, listed = "codigo_boleto", f"{warehouse.root}/_progress/{ledger}"
    last = warehouse.land(history.groupBy(key).agg(F.max(slice_column).alias("__last")), "last-slices")
    done = warehouse.spark.read.schema("slice string").option("recursiveFileLookup", True)
    finished = {row[0] for row in done.parquet(listed).collect()} if warehouse.has_files(listed) else set()
    # One row for each slice of the calendar.
    slices = sorted(row[0] for row in last.select("__last").distinct().collect() if row[0] is not None)
    todo = [value for value in slices if str(value) not in finished]
    for value in todo:
        own = last.filter(F.col("__last") == F.lit(value)).select(F.col(key).alias("__key"))
        records = history.filter(F.col(slice_column) == F.lit(value))
        records = records.join(own, records[key].eqNullSafe(own["__key"]), "left_semi")
        _load_history(warehouse, records.drop(slice_column) if slice_column not in order else records, run, order)
        marked = warehouse.spark.createDataFrame([(str(value),)], "slice string")
        marked.coalesce(1).write.mode("append").parquet(listed)
    return len(todo)


def _load_history(warehouse: Warehouse, records: DataFrame, run: Run, order: Sequence[str]) -> None:
    clean = warehouse.land(T.clean_invoices(records, order, last_of_repeats=True), "initial-invoices")
    invoices, bridge = T.invoice_tables(clean, run.reference)
    bridge = warehouse.land(bridge, "initial-bridge")
    batch, keyed = _with_customer_key(warehouse, invoices, FACT_KEYS)
    warehouse.upsert_ranges(FACTS, batch, FACT_KEYS, keyed=keyed)
    load_bridge(warehouse, bridge, run)
    warehouse.release(keyed, clean, bridge)


def _transforms(lookup: DataFrame, run: Run, order: Sequence[str]) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """For each entity, what makes its raw records fit to be loaded."""
    return {
        "statuses": lambda raw: T.transform_statuses(raw, order),
        "invoice_statuses": lambda raw: T.transform_invoice_statuses(raw, order),
        "volunteers": lambda raw: T.transform_volunteers(raw, order),
        "cooperatives": lambda raw: T.transform_cooperatives(raw, order),
        "regionals": lambda raw: T.transform_regionals(raw, order),
        "customers": lambda raw: T.transform_customers(raw, lookup, run.reference, order),
        "vehicles": lambda raw: T.transform_vehicles(raw, order),
        "invoices": lambda raw: T.clean_invoices(raw, order),
        "delinquency": lambda raw: T.transform_delinquency(raw, run.reference, order),
    }


def _load_invoices(warehouse: Warehouse, clean: DataFrame, run: Run) -> None:
    invoices, bridge = T.invoice_tables(clean, run.reference)
    bridge = warehouse.land(bridge, "bridge")
    load_facts(warehouse, invoices, run)
    load_bridge(warehouse, bridge, run)
    warehouse.release(clean, bridge)


def daily_run(
    warehouse: Warehouse,
    raw: Mapping[str, DataFrame],
    lookup: DataFrame,
    run: Run,
    order: Sequence[str],
    status: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Transform every entity, load dimensions, facts, bridge and snapshot in that order, then refresh the views.

    Each transformed table is landed once, since its load reads it several times. With ``status``, a frame of slice
    and error for each extraction by entity, no entity with a failed slice is loaded, nor any other.
    """
    for entity, slices in (status or {}).items():
        checks.refuse_incomplete(slices, "slice", "error", entity)

    def processed(entity: str, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return warehouse.land(transform(raw[entity]), entity)

    def one_by_one(names: Sequence[str]) -> dict[str, DataFrame]:
        return {entity: processed(entity, transforms[entity]) for entity in names}

    transforms = _transforms(lookup, run, order)
    # The two that have a row for each invoice go one after the other, so that only one has shuffle files at a time.
    names = [entity for entity in transforms if entity not in PER_INVOICE]
    done, failures = _together({entity: partial(one_by_one, [entity]) for entity in names} | {"": partial(one_by_one, PER_INVOICE)})
    for failure in failures.values():
        raise failure
    landed = {entity: frame for some in done.values() for entity, frame in some.items()}
    changes = load_dimensions(warehouse, landed, run)
    _load_invoices(warehouse, landed["invoices"], run)
    load_snapshot(warehouse, landed["delinquency"], run)
    warehouse.release(*landed.values())
    register_views(warehouse)
    return changes


def invoices_of_the_day(landed: DataFrame, run: Run, order: Sequence[str]) -> DataFrame:
    """Landed invoices in a window by emission, payment or due day; the last window and record of each wins."""
    days = {"__emission": "data_emissao", "__payment": "data_pagamento", "__due": "data_vencimento"}
    dated = landed.withColumns({name: clean_date(F.col(source)) for name, source in days.items()})
    hits = incremental_windows(dated, run.reference, *days)
    return merge_windows(hits, "codigo_boleto", list(order)).drop("window", "window_rank", *days)


def daily_pipeline(
    warehouse: Warehouse,
    landing: str,
    schemas: Mapping[str, StructType | str],
    lookup: DataFrame,
    run: Run,
    status: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The day's loads from a landing folder with a folder of JSON records for each entity: what is new there, once.

    Each entity is a stream of files with its own progress, kept with the warehouse, in the order of ``daily_run``:
    all dimensions at the same time, then invoices in their windows and their bridge, then the snapshot and the views.
    A rerun finds nothing new and changes nothing. After a failure the entities that were loaded stay loaded, and the
    next run goes on with the files of those that were not, as of its own day. An entity without new files is left
    as it is.
    """
    for entity, slices in (status or {}).items():
        checks.refuse_incomplete(slices, "slice", "error", entity)
    transforms = _transforms(lookup, run, INGEST_ORDER)

    def take(entity: str, load: Callable[[DataFrame], None]) -> None:
        progress = f"{warehouse.root}/_progress/{entity}"
        load_new_files(warehouse.spark, f"{landing}/{entity}", schemas[entity], progress, load)

    def dimension(entity: str) -> DataFrame | None:
        changes = []

        def load(raw: DataFrame) -> None:
            batch = warehouse.land(transforms[entity](raw), entity)
            changes.append(load_dimension(warehouse, entity, batch, run))
            warehouse.release(batch)

        take(entity, load)
        return changes[-1] if changes else None

    def invoices(raw: DataFrame) -> None:
        clean = transforms["invoices"](invoices_of_the_day(raw, run, INGEST_ORDER))
        _load_invoices(warehouse, warehouse.land(clean, "invoices"), run)

    def delinquency(raw: DataFrame) -> None:
        open_ones = warehouse.land(transforms["delinquency"](raw), "delinquency")
        load_snapshot(warehouse, open_ones, run)
        warehouse.release(open_ones)

    found = _each_dimension(dimension)
    take("invoices", invoices)
    take("delinquency", delinquency)
    register_views(warehouse)
    return found


def register_views(warehouse: Warehouse) -> list[str]:
    """The four reporting views in the warehouse's catalog; they read what the tables hold when they are read."""
    return create_views(warehouse.spark, warehouse.database)


def warehouse_ages(warehouse: Warehouse, now: datetime) -> DataFrame:
    """Hours since the last write of every monitored table."""
    monitored = {table: (warehouse.read(table), stamp) for table, stamp in E.MONITORED_TABLES.items()}
    return checks.table_ages(monitored, now)
