import itertools
import random
import time

import duckdb
import pytest

from ledgerloom.llm.interaction import SQL, audit, changes, op11_interaction

DOCS = "doc_id long, text string, source string, part int, mask string, key string"
LABELS = "doc_id long, quality int, toxic int, n int"
SF = "/root/testdata/sf0.001"


def fails(text):
    words = [w for w in text.translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ") if w]
    capitals = sum("A" <= c <= "Z" for c in text)
    own = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * capitals > 5 * len(text), any(c in "#$%&*|" for c in text)]
    return {x for x, failed in zip("ABCD", own) if failed}


def brute(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for doc_id, text, source in docs:
        text = text or ""
        copy = any(i is not None and doc_id is not None and i < doc_id and (t or "") == text for i, t, _ in docs)
        rows.append((source or "", fails(text) | ({"E"} if copy else set()), doc_id in good, doc_id in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = {x: 0 for x in "ABCDE"}
        for order in itertools.permutations("ABCDE"):
            for _, failed, _, _ in own:
                if failed:
                    shapley[min(failed, key=order.index)] += 1
        for order in itertools.permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                removed = [r for r in own if letter in r[1] and not r[1] & before]
                out[part, "".join(order), step] = (
                    sum(not r[1] & (before | {letter}) for r in own), len(removed), sum(letter in r[1] and bool(r[1] & before) for r in own),
                    sum(r[1] == {letter} for r in own), sum(r[2] for r in removed), sum(r[3] for r in removed), shapley[letter],
                )
    return out


def written(spark, folder, docs, files):
    """Each file on its own and later than the one before, as the stream takes them by age."""
    for k, at in enumerate(range(0, len(docs), -(-len(docs) // files))):
        rows = [(i, t, s, 7, "clash", "clash") for i, t, s in docs[at : at + -(-len(docs) // files)]]
        spark.createDataFrame(rows, DOCS).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)


def sample(seed):
    rng = random.Random(seed)
    texts = [None, "", " \t\n", "word " * 60, "One TWO three", " ".join(f"w{i}" for i in range(80)), " ".join(f"w{i}|" for i in range(50)), "é" * 30, "A" * 20, "x y " * 40_000]
    texts += [" ".join(rng.choice("abc#").join(["q", str(rng.randrange(99))]) for _ in range(rng.randrange(90))) for _ in range(15)]
    docs = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice([None, "", "s1", "s2"])) for _ in range(120)]
    docs += [(9, "same", "s1")] * 5 + [(9, "same", "s2"), (2**60 + 1, "same", "s1"), (8, "same", "s2"), (-5, "same", None)] + [(None, "same", "s1")] * 40
    rng.shuffle(docs)
    labels = [(i, rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for i in [*range(20), *range(10), 8, 9, None]]
    return docs, labels


@pytest.mark.parametrize("files, per_batch", [(6, 1), (1, 4)])
def test_retractions_give_what_a_reading_at_once_gives(spark, tmp_path, files, per_batch):
    docs, labels = sample(files)
    written(spark, str(tmp_path / "d"), docs, files)
    got = audit(spark, str(tmp_path / "d"), spark.createDataFrame([(*x, 1) for x in labels], LABELS), files_per_batch=per_batch)
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got.collect()}
    assert got == brute(docs, labels)


def test_smaller_ids_in_later_files_take_counts_back(spark, tmp_path):
    docs = [(i, "same", f"s{i}") for i in (5, 4, 6, 3)]
    written(spark, str(tmp_path / "d"), docs, 4)
    rows = changes(spark, str(tmp_path / "d"), files_per_batch=1).collect()
    assert sorted((r.doc_id, r.mask, r.n) for r in rows) == sorted([(5, 1, 1), (5, 1, -1), (5, 17, 1), (4, 1, 1), (4, 1, -1), (4, 17, 1), (6, 17, 1), (3, 1, 1)])


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "d"))
    assert audit(spark, str(tmp_path / "d"), spark.createDataFrame([], LABELS)).count() == 0


def test_sql_agrees_on_the_whole_table(spark):
    got = op11_interaction(spark, SF).toPandas()
    db = duckdb.connect()
    for name in ("documents", "labels"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    want = db.sql(SQL).df()
    keys = ["part", "filter_order", "step"]
    assert len(got) == 600 * want["part"].nunique()
    assert got.sort_values(keys)[sorted(got)].values.tolist() == want.sort_values(keys)[sorted(want)].values.tolist()
