import random

import numpy as np
import pytest

from ledgerloom.llm import decontamination as D
from ledgerloom.llm.passages import words_of

DOCS, ITEMS = "doc_id long, text string, item_id string, score string", "item_id long, text string, extra int"


def smith_waterman(a, b):
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(max(0, above[j - 1] + (1 if x == y else -1), above[j] - 1, row[-1] - 1))
        best, above = max(best, *row), row
    return best


def brute(docs, items):
    out = {}
    for d, text in docs:
        for i, question in items:
            own = words_of(question)
            if own and (score := smith_waterman(own, words_of(text))) >= D.needed_score(len(own)):
                out[d, i] = score / len(own)
    return out


def test_alignment_against_the_plain_recurrence():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = rng.integers(0, 6, rng.integers(1, 15)), rng.integers(0, 6, rng.integers(1, 30))
        score, start, end = D.align(a, b)
        assert score == smith_waterman(a.tolist(), b.tolist())
        assert score == smith_waterman(a.tolist(), b[start:end].tolist())


@pytest.mark.parametrize("block", [400, D.BLOCK_BYTES])
def test_edited_copies_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_BYTES", block)
    rng = random.Random(block)
    vocabulary = [f"w{i}" for i in range(60)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(words(rng.randint(1, 40)))) for i in range(25)] + [(25, None), (26, ""), (27, "!?")]
    items += [(28, items[5][1].upper()), (29, "one"), (30, "two words")]
    docs = [(1000, None), (1001, ""), (None, items[7][1]), (1002, "One, two-words!"), (1003, items[9][1] * 3), (1003, items[9][1] * 3)]
    for d in range(250):
        body = words(rng.randint(0, 60))
        copy = words_of(items[rng.randrange(25)][1])
        for _ in range(rng.randint(0, max(1, len(copy) // 4))):
            at = rng.randrange(len(copy)) if copy else 0
            copy[at : at + rng.choice([0, 1])] = rng.choice([[], ["x"], words(1)])
        at = rng.randint(0, len(body))
        docs.append((d, " ".join(body[:at] + copy + body[at:])))
    frame = spark.createDataFrame([(*d, "c", "c") for d in docs], DOCS)
    rows = D.contaminated(frame, spark.createDataFrame([(*i, 1) for i in items], ITEMS)).collect()
    assert {(r.doc_id, r.item_id): r.score for r in rows} == pytest.approx(brute(docs, items))
    assert len(rows) == len(brute(docs, items)) + sum(r.doc_id == 1003 for r in rows) / 2
    for r in rows:
        text = next(t for d, t in docs if d == r.doc_id)
        own = words_of(next(t for i, t in items if i == r.item_id))
        assert smith_waterman(own, words_of(text)[r.start_word : r.end_word]) / len(own) == pytest.approx(r.score)


def test_filter_drops_these_rows_only(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(1, f"x {item} y"), (2, None), (3, "clean words alone"), (None, item), (4, item.replace("zeta", "other")), (5, "alpha beta gamma"), (3, "clean words alone")]
    kept = D.without_contaminated(spark.createDataFrame([(*d, "c", "c") for d in docs], DOCS), spark.createDataFrame([(7, item, 1)], ITEMS)).collect()
    assert [r.doc_id for r in kept] == [2, 3, 5, 3]
    assert kept[0].asDict().keys() == {"doc_id", "text", "item_id", "score"}


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b c", "", "")], DOCS), spark.createDataFrame([(1, "a b c", 1)], ITEMS)
    assert D.contaminated(docs.limit(0), items).count() == 0
    assert D.contaminated(docs, items.limit(0)).count() == 0


def test_whole_table(spark):
    path = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]
    whole = {(d, i) for d, t in docs for i, q in items if f" {' '.join(words_of(q))} " in f" {' '.join(words_of(t))} "}
    found = {(r.doc_id, r.item_id): r.score for r in D.op7_decontamination(spark, path).collect()}
    assert {k for k, s in found.items() if s == 1} == whole
    assert whole


def test_no_copy_within_the_bound_is_lost_at_any_length():
    """Items of 8 to 20 words with the most edits that the score allows, against an alignment of the whole text."""
    import random

    import numpy as np

    from ledgerloom.llm import decontamination as D

    def whole(a, b):
        above, best = [0] * (len(b) + 1), 0
        for x in a:
            row = [0]
            for j, y in enumerate(b):
                row.append(max(0, above[j] + (1 if x == y else -1), above[j + 1] - 1, row[j] - 1))
            best, above = max(best, *row), row
        return best

    rng = random.Random(1)
    for length in range(8, 21):
        for _ in range(60):
            words = [f"w{i}" for i in range(length)]
            copy, spare = list(words), length - D.needed_score(length)
            while spare > 0:
                if rng.random() < 0.6 or spare == 1:
                    copy.insert(rng.randrange(1, len(copy)), "foreign")
                    spare -= 1
                else:
                    copy[rng.randrange(len(copy))] = "changed"
                    spare -= 2
            items = D.Items([(1, " ".join(words))])
            items.keep_rarest({}, D.LEAST_SCORE)
            found = list(D.matches(items, " ".join(["before"] * 5 + copy + ["after"] * 5), D.LEAST_SCORE))
            score = whole(words, copy)
            assert bool(found) == (score >= D.needed_score(length))
            if found:
                assert np.isclose(found[0][1], score / length)
    items = D.Items([(1, "alpha beta gamma delta eps zeta eta theta")])
    items.keep_rarest({}, D.LEAST_SCORE)
    assert list(D.matches(items, "alpha beta x gamma delta x eps zeta x eta theta", D.LEAST_SCORE))
