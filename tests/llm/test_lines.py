import random
from pathlib import Path

import numpy as np

from ledgerloom.llm import lines as L

SCHEMA = "doc_id long, text string, line string, h int"


def brute(docs):
    """(row number in docs, line) -> (kept row, kept line, edits), comparing all lines with all earlier ones."""
    every = []
    for row, (doc, text) in enumerate(docs):
        every += [((doc is None, doc or 0, row, n), w) for n, line in enumerate((text or "").split("\n")) if (w := L.normal_words(line))]
    every.sort()
    out = {}
    for i, (place, words) in enumerate(every):
        for earlier, other in every[:i]:
            near = min(len(words), len(other)) >= L.EDITABLE_WORDS and L.within_one_edit(words, other)
            if words == other or near:
                out[place[2], place[3]] = (earlier[2], earlier[3], int(words != other))
                break
    return out


def frame(spark, docs):
    return spark.createDataFrame([(*d, "c", 1) for d in docs], SCHEMA).coalesce(1)


def some_docs(rng):
    bases = [[rng.choice("abcdefghij") for _ in range(rng.randint(1, 14))] for _ in range(12)]
    docs = [(None, "one two three four five\nx"), (None, None), (900, ""), (901, "\n \n\n"), (902, "Aa  bB\taa aA Cc\nshort\nShort"), (5, "aa bb aa aa cc"), (5, "aa bb aa aa cc")]
    for d in range(120):
        lines = []
        for _ in range(rng.randint(0, 6)):
            words = list(rng.choice(bases))
            for _ in range(rng.randint(0, 2)):
                at = rng.randint(0, len(words))
                words[at : at + rng.choice([0, 1])] = rng.choice([[], [rng.choice("abcxyz")]])
            lines.append(" ".join(words))
        docs.append((d, "\n".join(lines)))
    rng.shuffle(docs)
    return docs


def test_against_brute_force(spark):
    for seed in (1, 2):
        docs = some_docs(random.Random(seed))
        df = frame(spark, docs)
        order = {r.row: i for i, r in enumerate(L.with_row_id(df, "row").select("row").collect())}
        rows = L.repeated_lines(df).collect()
        assert {(order[r.row], r.line): (order[r.kept_row], r.kept_line, r.edits) for r in rows} == brute(docs)
        assert len(rows) == len(brute(docs))


def test_texts_lose_these_lines_and_nothing_else(spark):
    docs = some_docs(random.Random(9)) + [(7000, "long " * 30_000 + "\nunique line of its own here"), (7001, "long " * 30_001)]
    got = L.without_repeated_lines(frame(spark, docs)).collect()
    gone = brute(docs)
    want = [(d, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (row, n) not in gone)) for row, (d, t) in enumerate(docs)]
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(want, key=repr)
    assert got[0].asDict().keys() == {"doc_id", "text", "line", "h"}


def test_block_keys_meet_for_every_edit():
    rng, powers = random.Random(4), L.Powers()
    for _ in range(400):
        a = [rng.choice("abcdef") for _ in range(rng.randint(5, 40))]
        b, at = list(a), rng.randrange(len(a))
        b[at : at + rng.choice([0, 1])] = [rng.choice("uvw")]
        other = ["p"] * rng.randint(5, 9)
        lines = [a, other, b]
        hashes = np.fromiter(map(L.WordHash().__getitem__, sum(lines, [])), np.uint64)
        keys = L.block_keys(hashes, np.array([len(x) for x in lines]), powers).tolist()
        assert set(keys[0]) & set(keys[2])
        assert not set(keys[1]) & set(keys[0] + keys[2])


def test_empty_table(spark):
    assert L.repeated_lines(frame(spark, [])).count() == 0
    assert L.without_repeated_lines(frame(spark, [])).count() == 0


def test_whole_table(spark):
    path = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    got = {(r.doc_id, r.line): (r.kept_doc_id, r.kept_line, r.edits) for r in L.op9_line_dedup(spark, path).collect()}
    assert got == {(docs[row][0], n): (docs[k][0], m, e) for (row, n), (k, m, e) in brute(docs).items()}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        at = rng.randint(0, len(out))
        out[at : at + rng.choice([0, 1, 1])] = rng.choice([[], [rng.choice("uvwxyz")], [rng.choice("uvwxyz")]])
    return out


def test_distance_and_bound_by_the_whole_table():
    rng = random.Random(12)
    for _ in range(400):
        a = [rng.choice("abcd") for _ in range(rng.randint(1, 40))]
        b = edited(rng, a, rng.randint(0, 9)) or ["a"]
        assert L.edit_distance(a, b) == distance(a, b)
        assert L.within_one_edit(a, b) == (distance(a, b) <= 0.2 * max(len(a), len(b)))


def test_long_lines_go_at_a_similarity_of_four_fifths(spark, monkeypatch):
    monkeypatch.setattr(L, "CANDIDATES", 1)
    rng = random.Random(31)
    lines = []
    for _ in range(12):
        base = [rng.choice("abcdefghij") + rng.choice("klmno") for _ in range(rng.randint(5, 60))]
        lines += [" ".join(edited(rng, base, rng.randint(0, len(base) // 4))) for _ in range(12)]
    rng.shuffle(lines)
    words = [x.split() for x in lines]
    want = {}
    for i, a in enumerate(words):
        close = (j for j, b in enumerate(words[:i]) if a == b or min(len(a), len(b)) >= 5 and distance(a, b) <= 0.2 * max(len(a), len(b)))
        if (kept := next(close, None)) is not None:
            want[i] = kept
    got = L.repeated_lines(frame(spark, [(i, x) for i, x in enumerate(lines)])).collect()
    assert {r.doc_id: r.kept_doc_id for r in got} == want
    assert sum(distance(words[i], words[k]) > 1 for i, k in want.items()) > 20


def test_words_of_every_text_are_counted(spark):
    texts = spark.createDataFrame([(i, f"W{i} w{i}\nw{i} common") for i in range(64)], "row long, text string")
    powers, words = L._word_powers(texts), L.WordHash()
    hashes = np.array([words[f"w{i}"] for i in range(64)] + [words["common"]], np.uint64)
    assert (powers.of(hashes) == [2] * 64 + [6]).all()


def test_pairs_and_their_texts_go_when_they_are_compared(spark, monkeypatch):
    monkeypatch.setattr(L, "CANDIDATES", 1)
    from ledgerloom.session import shared_dir

    def left():
        return {path for label in ("candidates", "likely", "met-texts") for path in Path(shared_dir(spark)).glob(f"ledgerloom/{label}-*")}

    before, docs = left(), [(i, f"one two three four five six seven eight nine n{i % 40}\na b c d e f g h i j k{i}") for i in range(80)]
    moved, settle = [], L.settle

    def counted(df, label, path=None):
        df = settle(df, label, path)
        moved.append((label, df.count()))
        return df

    monkeypatch.setattr(L, "settle", counted)
    assert len(L.repeated_lines(frame(spark, [*docs, *((100 + i, " ".join(f"u{i}w{j}" for j in range(9)) + " x y") for i in range(50))])).collect()) == 158
    assert left() == before
    assert {"likely", "met-texts"} <= {label for label, _ in moved}  # no text meets another before the sieve
    assert max(n for label, n in moved if label == "met-texts") <= 120


def test_fewer_keys_than_pairs_that_edits_spoil():
    rng, powers = random.Random(6), L.Powers()
    for n in (12, 40, 200):
        lines = [[f"w{rng.randrange(10**9)}" for _ in range(n)] for _ in range(60)]
        hashes = L.WordHash().of(sum(lines, []))
        keys, owner, at = L.prefixes(hashes, np.full(60, n), powers)
        count = np.bincount(owner, minlength=60)
        assert (count > L.most_words(n)).all()
        assert count.mean() < 0.85 * (2 * L.most_words(n) + 1)
        for i in range(60):  # one edit fewer leaves a key
            places, spoilt = sorted(at[owner == i]), 0
            while places:
                places, spoilt = [p for p in places[1:] if p != places[0] + 1], spoilt + 1
            assert spoilt > L.most_words(n)


def test_lines_meet_where_a_key_stands_at_suitable_places(spark):
    shift = [("a b " + " ".join(f"x{i}" for i in range(18))), (" ".join(f"y{i}" for i in range(18)) + " a b")]
    near = ["k " + " ".join(f"z{i}" for i in range(19)), " ".join(f"z{i}" for i in range(19)) + " k"]
    texts = frame(spark, list(enumerate(shift + near))).select("doc_id", "text")
    blocks = L._block_rows(texts, L.Powers())
    assert "bucket" in blocks.columns  # packed, not a row for each key
    ids = [L.line_id(L.normal_words(x))[0] for x in shift + near]
    assert {r.h for r in L._shared(blocks).collect()} == set(ids[2:])


def test_copies_and_near_copies_of_one_line_are_not_compared_with_each_other(spark, monkeypatch):
    """A class of near lines makes a few pairs for each line, not a pair for any two."""
    moved, settle = [], L.settle

    def counted(df, label, path=None):
        df = settle(df, label, path)
        moved.append((label, df.count()))
        return df

    monkeypatch.setattr(L, "settle", counted)
    docs = [(i, "one two three four five six seven eight nine " + f"n{i}") for i in range(300)]
    assert {(r.doc_id, r.kept_doc_id) for r in L.repeated_lines(frame(spark, docs)).collect()} == {(i, 0) for i in range(1, 300)}
    assert sum(n for label, n in moved if label == "likely") <= 300 * (L.CANDIDATES + 1) * 3


def test_a_line_that_repeats_a_pair_sends_it_once(spark):
    rng = random.Random(8)
    lines = [["is", "onhe."] * 150 for _ in range(6)]
    for words in lines:
        for _ in range(20):
            words[rng.randrange(len(words))] = rng.choice("uvwxyz")
    texts = frame(spark, [(i, " ".join(words)) for i, words in enumerate(lines)]).select("doc_id", "text")
    shared = L._shared(L._block_rows(texts, L.Powers()))
    assert shared.select("h").distinct().count() == 6
    assert shared.groupBy("h", "key").count().where("count > 1").isEmpty()


def test_places_of_repeated_pairs_align_if_any_two_do():
    rng = random.Random(3)
    for _ in range(300):
        n, m = rng.randint(5, 60), rng.randint(5, 60)
        a, b = (sorted(rng.sample(range(x), rng.randint(1, 4))) for x in (n, m))
        every = any(abs(y - x) + abs((m - n) - (y - x)) <= max(n, m) // L.EDITABLE_WORDS for x in a for y in b)
        assert L._aligns(n, a[0], a[-1], m, b[0], b[-1]) or not every
        assert not (len(a) == len(b) == 1 and not every and L._aligns(n, a[0], a[-1], m, b[0], b[-1]))


def test_later_rounds_go_on_where_lists_were_cut(spark, monkeypatch):
    """Only lists that were cut short are taken again, and behind what was compared."""
    monkeypatch.setattr(L, "CANDIDATES", 1)
    rounds, candidates = [], L._candidates

    def counted(rows, most):
        rounds.append(rows.groupBy("key").agg({"after": "max", "h": "count"}).collect())
        return candidates(rows, most)

    monkeypatch.setattr(L, "_candidates", counted)
    rng, docs = random.Random(5), []
    for _ in range(40):
        base = [f"w{rng.randrange(60)}" for _ in range(20)]
        docs += [(len(docs) + i, " ".join(edited(rng, base, rng.randint(0, 6)))) for i in range(8)]
    got = L.repeated_lines(frame(spark, docs)).collect()
    assert {(r.doc_id, r.line): (r.kept_doc_id, r.kept_line, r.edits) for r in got} == {(row, n): (k, m, e) for (row, n), (k, m, e) in brute(docs).items()}
    assert len(rounds) > 1
    assert all(key["max(after)"] > 0 for later in rounds[1:] for key in later)
    assert sum(key["count(h)"] for key in rounds[1]) < sum(key["count(h)"] for key in rounds[0])


def test_words_are_hashed_together_as_one_by_one(monkeypatch):
    words = [*(f"w{i}" for i in range(5000)), "a", "aa", "a\0", "\0", "\0\0", "ab", "ba", "straße", "\U0001f600", "x" * 70_000]
    hashes = L.WordHash().of(words)
    assert len(np.unique(hashes)) == len(words)
    assert [L.WordHash()[w] for w in words[-12:]] == hashes[-12:].tolist()
    monkeypatch.setattr(L, "HASHED_WORDS", 7)
    assert (L.WordHash().of(words) == hashes).all() and len(L.WordHash().of([])) == 0
    spread = np.bincount((hashes[:5000] % np.uint64(256)).astype(int), minlength=256)
    assert spread.min() > 0 and spread.max() < 60  # the lowest bits choose buckets and the bits of word sets


def test_texts_are_split_once_for_lines_and_counts(spark, monkeypatch):
    texts = spark.createDataFrame([(i, i, f"W{i} w{i}\nw{i} common\n\n") for i in range(64)], "doc_id long, row long, text string")
    counted = L._lines(texts).cache()
    assert counted.where("words is null").count() == 128
    monkeypatch.setattr(L, "_lines", lambda texts: 1 / 0)
    powers, words = L._word_powers(counted), L.WordHash()
    hashes = np.array([words[f"w{i}"] for i in range(64)] + [words["common"]], np.uint64)
    assert (powers.of(hashes) == [2] * 64 + [6]).all() and powers.words == 256
