import binascii
import hashlib
import random

import pytest

from ledgerloom.llm.merkle import Subtree, levels_of, manifest, op12_merkle, tampered

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, at int, size int"
SF = "/root/testdata/sf0.001"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return digest(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])


def tree_of(nodes):
    """All levels, the lowest first."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def proof_of(levels, i):
    out = []
    for nodes in levels[:-1]:
        start = i // 16 * 16
        out.append((nodes[start:i], nodes[i + 1 : start + 16]))
        i //= 16
    return out


def brute(docs):
    sources = {}
    for doc_id, text, lang, source, n_chars in docs:
        changed = doc_id is not None and binascii.crc32(str(doc_id).encode()) % 5 == 0 and text is not None
        low = text.translate({c: c + 32 for c in range(65, 91)}) if changed else text
        sources.setdefault(source, []).append((doc_id, leaf_of(doc_id, source, lang, n_chars, text), leaf_of(doc_id, source, lang, n_chars, low)))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        sources[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(r[1])))
        trees[name] = tree_of([r[1] for r in sources[name]])
    upper = tree_of([trees[n][-1][0] for n in names])
    root, out = upper[-1][0], []
    for k, name in enumerate(names):
        for i, (doc_id, leaf, replacement) in enumerate(sources[name]):
            path = proof_of(trees[name], i) + proof_of(upper, k)
            value = replacement
            for left, right in path:
                value = digest(*left, value, *right)
            out.append((doc_id, leaf, trees[name][-1][0], root, digest(*[x for left, right in path for x in left + right]), value, value == root))
    return sorted(out, key=str)


def found(rows):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in rows), key=str)


def frame(spark, docs):
    return spark.createDataFrame([(i, t, lang, s, n, "clash", 1, 2) for i, t, lang, s, n in docs], SCHEMA)


def test_levels():
    assert [levels_of(n) for n in (0, 1, 2, 16, 17, 256, 257, 4096, 4097)] == [0, 0, 1, 1, 2, 2, 3, 3, 4]


@pytest.mark.parametrize("sizes", [[1], [16], [17, 1], [256, 2, 257], [700, 1, 33, 16]])
def test_small_trees(spark, sizes):
    rng = random.Random(sum(sizes))
    docs = [(rng.randrange(10**6), rng.choice(["A b C", "low", "É Ä", "X" * 50]), "en", f"s{k}", 3) for k, n in enumerate(sizes) for _ in range(n)]
    rng.shuffle(docs)
    assert found(manifest(tampered(frame(spark, docs))).collect()) == brute(docs)


def test_many_sources_nulls_ties_and_long_texts(spark):
    rng = random.Random(3)
    docs = [(i, f"Text {i}", None, f"src{i % 290}", None) for i in range(600)]
    docs += [(None, None, None, None, None)] * 3 + [(5, "", "", "", 0), (5, "B", "x", "", 0), (5, "A", "x", "", 0), (10, "Q" * 400_000, "é", "ü", 1), (-7, "Z", "s", "s", 2)]
    docs += [(77, "Same", "en", "hot", 4)] * 40
    rng.shuffle(docs)
    assert found(manifest(tampered(frame(spark, docs))).collect()) == brute(docs)


def test_empty_table(spark):
    assert manifest(tampered(frame(spark, []))).count() == 0


def test_folding_resumes_the_state_before_the_slot():
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(40)]
    subtree = Subtree(digests, 2)
    for i in range(40):
        other = hashlib.sha256(b"new").digest()
        assert subtree.folded(i, subtree.levels[0][i], subtree.siblings(i)) == subtree.top
        assert subtree.folded(i, other.hex().encode(), subtree.siblings(i)) == Subtree([*digests[:i], other, *digests[i + 1 :]], 2).top


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()
    rows = op12_merkle(spark, SF).collect()
    assert found(rows) == brute([tuple(d) for d in docs])
    assert 0 < sum(not r.verified for r in rows) < len(rows)
