import random

import numpy as np
import pytest
import xxhash

from ledgerloom.llm import simhash as S

SCHEMA = "doc_id long, text string, row string, component string"


def fingerprint(text: str) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids_fps):
    """Smallest id reachable, by comparing all pairs."""
    ids, fps = zip(*ids_fps)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, doc in enumerate(ids):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return [least[find(i)] for i in range(len(ids))]


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_pairs(radius):
    rng = random.Random(radius)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(150):
        x = rng.choice(fps)
        for b in rng.sample(range(64), rng.randint(1, 5)):
            x ^= 1 << b
        fps.append(x)
    i, j = S.near_pairs(np.array(fps, np.uint64), radius)
    want = {(a, b) for a in range(300) for b in range(300) if a != b and (fps[a] ^ fps[b]).bit_count() <= radius}
    assert set(zip(i.tolist(), j.tolist())) == want


def test_texts_against_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6)))
    texts = [None, "", " \t\n", "one", "Two words", "A\x1cb c\xa0d É", "w " * 60_000]
    for _ in range(40):
        words = [word() for _ in range(rng.randint(3, 400))]
        texts += [" ".join(words), "\n".join(words)]
        words[rng.randrange(len(words))] = word()
        texts.append(" ".join(words))
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    got = S.with_component_id(S.simhash(spark.createDataFrame(rows, SCHEMA))).select("doc_id", "fp", "component_id").collect()
    fps = [fingerprint(t) for t in texts]
    assert {r.doc_id: r.fp % 2**64 for r in got} == dict(enumerate(fps))
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(groups(list(enumerate(fps)))))


def test_chain_and_hot_group_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(S, "TILE_ROWS", 16)
    rng = random.Random(2)
    chain = [rng.getrandbits(64)]
    for _ in range(120):
        chain.append(chain[-1] ^ (1 << rng.randrange(40)))
    fps = sorted(set(chain) | {rng.getrandbits(64) for _ in range(60)})
    edges = S.links(spark.createDataFrame([(S._signed(f),) for f in fps], "fp long"))
    found = {r.node: r.root for r in S.components(edges).collect()}
    want = groups(list(enumerate(fps)))
    names = [found.get(S._signed(f), S._signed(f)) for f in fps]
    assert len({(a, b) for a, b in zip(names, want)}) == len(set(want)) == len(set(names))


def test_representatives_keep_all_columns_and_one_of_each(spark):
    rows = [(7, "a b c d e", "r", "c"), (2, "a b c d e", "s", "d"), (2, "a b c d e", "s", "d"), (None, "A B c D e", "t", "e"), (9, "quite other words here", "u", None), (None, "null id only", None, None)]
    got = S.representatives(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or -1, r.row) for r in got if r.row) == [(2, "s"), (9, "u")]
    assert len(got) == 3
    assert S.representatives(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.op8_simhash(spark, "/root/testdata/sf0.001").collect()}
    fps = [fingerprint(d.text) for d in docs]
    want = groups([(d.doc_id, f) for d, f in zip(docs, fps)])
    assert got == {d.doc_id: (f"{f:016x}", w) for d, f, w in zip(docs, fps, want)}


def test_splits_that_change_before_the_reading_lose_no_document(spark, tmp_path):
    from ledgerloom.llm.lines import without_repeated_lines
    from ledgerloom.llm.simhash import representatives

    docs = [(i, f"document {i} tells of {i * i} things and of {i * 7} more\nthe same line stands in every one\nend of {i}") for i in range(80)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "d"))
    read = spark.read.parquet(str(tmp_path / "d"))
    want = sorted(map(tuple, representatives(read).collect())), sorted(map(tuple, without_repeated_lines(read).collect()))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    frames = representatives(read), without_repeated_lines(read)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    try:
        got = tuple(sorted(map(tuple, f.collect())) for f in frames)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == want and len(got[1]) == 80
    assert sum("the same line" in t for _, t in got[1]) == 1
