"""Every branch of the Type 2 load, tested on data."""

from datetime import date, datetime

import pytest

from ledgerloom.operators import scd2

EPOCH = date(1900, 1, 1)
REF, NEXT = date(2026, 7, 1), date(2026, 7, 2)
OLD, NOW, LATER = datetime(2026, 6, 1), datetime(2026, 7, 1, 3), datetime(2026, 7, 2, 3)
DIM = (
    "k string, m string, n string, valido_de date, valido_ate date, vigente boolean, sk bigint, "
    "criado_em timestamp, atualizado_em timestamp"
)
BATCH = "k string, m string, n string"


def dimension(spark):
    rows = [
        ("A", "1", "x", EPOCH, None, True, 1),
        ("B", "1", "x", EPOCH, None, True, 2),
        ("C", "1", "x", EPOCH, date(2026, 5, 1), False, 3),
        ("E", "1", "x", EPOCH, None, True, 4),
        ("F", None, "x", EPOCH, None, True, 5),
        ("G", None, "x", EPOCH, None, True, 6),
        ("H", "1", "x", REF, None, True, 7),
    ]
    return spark.createDataFrame([(*row, OLD, OLD) for row in rows], DIM)


def batch(spark):
    rows = [("A", "1", "y"), ("B", "2", "x"), ("C", "1", "x"), ("D", "1", "x"), ("F", None, "x"), ("G", "1", "x"), ("H", "2", "x")]
    return spark.createDataFrame(rows, BATCH)


def apply(dim, new, reference=REF, now=NOW, monitored=("m",)):
    return scd2.apply_batch(dim, new, "k", list(monitored), reference, "sk", now)


def state(df):
    rows = df.select("k", "m", "n", "valido_de", "valido_ate", "vigente").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0], r[3]))


AFTER = [
    ("A", "1", "y", EPOCH, None, True),
    ("B", "1", "x", EPOCH, REF, False),
    ("B", "2", "x", REF, None, True),
    ("C", "1", "x", EPOCH, date(2026, 5, 1), False),
    ("C", "1", "x", date(2026, 5, 1), None, True),
    ("D", "1", "x", EPOCH, None, True),
    ("E", "1", "x", EPOCH, None, True),
    ("F", None, "x", EPOCH, None, True),
    ("G", None, "x", EPOCH, REF, False),
    ("G", "1", "x", REF, None, True),
    ("H", "2", "x", REF, None, True),
]


def test_every_branch(spark):
    after = apply(dimension(spark), batch(spark))
    assert state(after) == AFTER


def test_stamps_and_surrogate_keys(spark):
    rows = {(r.k, r.valido_de): r for r in apply(dimension(spark), batch(spark)).collect()}
    keys = [r.sk for r in rows.values()]
    assert len(set(keys)) == len(keys) and None not in keys
    for key, sk in [(("A", EPOCH), 1), (("B", EPOCH), 2), (("C", EPOCH), 3), (("E", EPOCH), 4), (("H", REF), 7)]:
        assert rows[key].sk == sk
    assert min(rows[k].sk for k in [("B", REF), ("C", date(2026, 5, 1)), ("D", EPOCH), ("G", REF)]) > 7
    assert rows["A", EPOCH].atualizado_em == NOW and rows["A", EPOCH].criado_em == OLD
    assert rows["B", EPOCH].atualizado_em == NOW and rows["B", REF].criado_em == NOW
    assert rows["C", EPOCH].atualizado_em == OLD and rows["E", EPOCH].atualizado_em == OLD
    assert rows["F", EPOCH].atualizado_em == NOW
    assert rows["H", REF].criado_em == OLD and rows["H", REF].atualizado_em == NOW


def test_rerun_of_a_day_changes_only_stamps(spark):
    once = apply(dimension(spark), batch(spark))
    twice = apply(once, batch(spark), now=LATER)
    assert state(twice) == AFTER
    numbered = lambda df: sorted((r.k, r.valido_de, r.sk) for r in df.collect())
    assert numbered(once) == numbered(twice)


def test_second_day(spark):
    first = apply(dimension(spark), batch(spark))
    second = apply(first, spark.createDataFrame([("B", "3", "z")], BATCH), NEXT, LATER)
    assert [r for r in state(second) if r[0] == "B"] == [
        ("B", "1", "x", EPOCH, REF, False),
        ("B", "2", "x", REF, NEXT, False),
        ("B", "3", "z", NEXT, None, True),
    ]
    assert [r for r in state(second) if r[0] != "B"] == [r for r in AFTER if r[0] != "B"]


def test_first_load(spark):
    dim = scd2.first_versions(batch(spark), "k", "sk", NOW)
    assert all(r.valido_de == EPOCH and r.valido_ate is None and r.vigente for r in dim.collect())
    assert len({r.sk for r in dim.collect()}) == 7


def test_changed_set_comes_from_the_state_before_closing(spark):
    changed = scd2.changed_keys(dimension(spark), batch(spark), "k", ["m"])
    closed = scd2.close_versions(dimension(spark), changed, "k", REF, NOW)
    assert sorted(r.k for r in changed.collect()) == ["B", "G", "H"]
    assert sorted(r.k for r in closed.filter("not vigente").collect()) == ["B", "C", "G", "H"]
    assert sorted(r.k for r in scd2.keys_without_current(dimension(spark), batch(spark), "k").collect()) == ["C", "D"]
    assert sorted(r.k for r in scd2.keys_to_open(dimension(spark), batch(spark), "k", ["m"]).collect()) == list("BCDGH")


def test_new_and_missing_batch_columns(spark):
    wider = spark.createDataFrame([("A", "1", "new"), ("B", "2", "new")], "k string, m string, p string")
    rows = {(r.k, r.valido_de): r for r in apply(dimension(spark), wider).collect()}
    assert (rows["A", EPOCH].n, rows["A", EPOCH].p) == ("x", "new")
    assert (rows["B", EPOCH].n, rows["B", EPOCH].p) == ("x", None)
    assert (rows["B", REF].n, rows["B", REF].p) == (None, "new")
    assert rows["E", EPOCH].p is None


def test_only_monitored_columns_leaves_unchanged_rows_alone(spark):
    same = spark.createDataFrame([("A", "1")], "k string, m string")
    rows = {r.k: r for r in apply(dimension(spark), same).filter("k = 'A'").collect()}
    assert rows["A"].atualizado_em == OLD


def test_null_key_is_not_inserted(spark):
    assert state(apply(dimension(spark), spark.createDataFrame([(None, "1", "x")], BATCH))) == state(dimension(spark))


def test_day_before_the_current_version_is_refused(spark):
    with pytest.raises(Exception, match="before the start"):
        apply(dimension(spark), spark.createDataFrame([("H", "2", "x")], BATCH), date(2026, 6, 1)).collect()


def test_refresh_versions(spark):
    rows = {r.k: r for r in scd2.refresh_versions(dimension(spark), batch(spark), "k", ["m"], NOW).collect()}
    assert (rows["A"].n, rows["A"].atualizado_em) == ("y", NOW)
    assert (rows["B"].n, rows["B"].atualizado_em) == ("x", OLD)


# --- versions stored by slice ------------------------------------------------------------------


def files_of(warehouse, table):
    from pathlib import Path

    return {str(p): p.stat().st_mtime_ns for p in Path(warehouse.root, table).rglob("*.parquet")}


def load(warehouse, new, reference=REF, now=NOW):
    from ledgerloom.plans.jobs import Run, apply_versions

    apply_versions(warehouse, "dim", new, "k", "sk", ["m"], Run(reference, now))


def test_slices_give_the_state_that_the_whole_gives(spark, warehouse):
    warehouse.replace_slices("dim", scd2.with_slice(dimension(spark)), scd2.SLICE, ["sk"])
    load(warehouse, batch(spark))
    assert state(warehouse.read("dim")) == AFTER and scd2.SLICE not in warehouse.read("dim").columns
    whole = apply(dimension(spark), batch(spark))
    # A rerun of the day, and a second day, as well; keys are unique throughout.
    load(warehouse, batch(spark))
    whole = apply(whole, batch(spark))
    assert state(warehouse.read("dim")) == state(whole) == AFTER
    again = spark.createDataFrame([("A", "9", "y"), ("B", "2", "z"), ("D", None, "x"), ("Z", "1", "q")], BATCH)
    load(warehouse, again, NEXT, LATER)
    whole = apply(whole, again, NEXT, LATER)
    assert state(warehouse.read("dim")) == state(whole)
    keys = [r.sk for r in warehouse.read("dim").collect()]
    assert len(set(keys)) == len(keys)


def test_closed_files_are_left_alone(spark, warehouse):
    load(warehouse, batch(spark), date(2026, 6, 1), OLD)
    changed = batch(spark).withColumn("m", scd2.F.concat("k", scd2.F.lit("!")))
    load(warehouse, changed)
    closed = {p: t for p, t in files_of(warehouse, "dim").items() if f"{scd2.SLICE}={REF}" in p}
    assert closed
    load(warehouse, changed.withColumn("m", scd2.F.lit("third")), NEXT, LATER)
    after = files_of(warehouse, "dim")
    assert {p: after.get(p) for p in closed} == closed and any(f"{scd2.SLICE}={NEXT}" in p for p in after)
    assert warehouse.read("dim").count() == 3 * batch(spark).count()
    # Without a change only the open slice is written.
    before = {p: t for p, t in after.items() if f"{scd2.SLICE}={scd2.OPEN}" not in p}
    load(warehouse, changed.withColumn("m", scd2.F.lit("third")), date(2026, 7, 3), datetime(2026, 7, 3, 3))
    after = files_of(warehouse, "dim")
    assert {p: after.get(p) for p in before} == before and {p for p in after if f"={scd2.OPEN}" not in p} == set(before)


def test_a_load_that_stopped_after_the_closings_can_be_repeated(spark, warehouse, monkeypatch):
    warehouse.replace_slices("dim", scd2.with_slice(dimension(spark)), scd2.SLICE, ["sk"])
    real, calls = type(warehouse).replace_slices, []

    def stops(self, *args, **options):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("driver lost")
        return real(self, *args, **options)

    monkeypatch.setattr(type(warehouse), "replace_slices", stops)
    with pytest.raises(OSError):
        load(warehouse, batch(spark))
    monkeypatch.setattr(type(warehouse), "replace_slices", real)
    load(warehouse, batch(spark))
    assert state(warehouse.read("dim")) == AFTER


def test_a_version_without_a_day_of_its_own_is_taken_up_again(spark, warehouse):
    rows = [("A", "1", "x", EPOCH, REF, False, 1, OLD, OLD), ("A", "2", "x", REF, REF, False, 2, OLD, OLD), ("B", "1", "x", EPOCH, REF, False, 3, OLD, OLD)]
    dim = spark.createDataFrame(rows, DIM)
    warehouse.replace_slices("dim", scd2.with_slice(dim), scd2.SLICE, ["sk"])
    new = spark.createDataFrame([("A", "3", "y")], BATCH)
    load(warehouse, new, NEXT, LATER)
    assert state(warehouse.read("dim")) == state(apply(dim, new, NEXT, LATER))
    assert {r.sk for r in warehouse.read("dim").filter("vigente").collect()} == {2}


def test_an_empty_batch_and_added_columns(spark, warehouse):
    load(warehouse, batch(spark))
    before = state(warehouse.read("dim"))
    load(warehouse, batch(spark).limit(0), NEXT, LATER)
    assert state(warehouse.read("dim")) == before
    load(warehouse, batch(spark).withColumn("extra", scd2.F.lit("e")), NEXT, LATER)
    assert {r.extra for r in warehouse.read("dim").filter("vigente").collect()} == {"e"} and state(warehouse.read("dim")) == before
