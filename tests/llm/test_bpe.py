import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from ledgerloom.llm import bpe

SCHEMA = "doc_id long, text string, row string, ids string, k int"


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "r", "s", 1) for i, t in enumerate(texts)], SCHEMA)


def ids_of(spark, texts, ranks, **sizes):
    df = frame(spark, texts)
    rows = bpe.with_row_id(df.select("doc_id"), "row").join(bpe.encode(df, ranks, public_tokenizers.PATTERN, **sizes), "row").collect()
    return {r.doc_id: list(struct.unpack(f"<{len(r.ids) // 4}I", r.ids)) for r in rows}


@pytest.mark.parametrize("piece", [b"a" * 30_000, b"\x00\xff" * 500, "日本語のテキスト".encode() * 40, b"abcabcabd" * 99])
def test_merge(ranks, reference, piece):
    assert bpe.merge(piece, ranks) == reference._core_bpe.encode_single_piece(piece)


def test_chunks_resynchronise(spark, ranks, reference):
    rng = random.Random(8)
    abc = "abcehilnorst  éß\n\n'9$日🙂A\x85 ​"
    texts = [None, "", " ", "short", "a" * 900, " " * 700, "\n" * 301, "'re" * 200, "x'" * 99 + "don't we'll " * 40]
    texts += ["".join(rng.choice(abc) for _ in range(rng.randint(90, 700))) for _ in range(150)]
    texts += ["word " * 30 + "b" * rng.randint(40, 200) + " end of it" * 20 for _ in range(10)] + ["same text " * 50] * 3
    got = ids_of(spark, texts, ranks, chunk=64, overlap=24)
    assert got == {i: reference.encode_ordinary(t or "") for i, t in enumerate(texts)}


def test_decoding_gives_the_bytes_back(spark, ranks):
    texts = ["Grüße 日本 🙂\x00", "", None, "a\r\n b"]
    df = frame(spark, texts)
    rows = bpe.decode(bpe.encode(df, ranks, public_tokenizers.PATTERN), ranks).collect()
    assert sorted(bytes(r.data) for r in rows) == sorted((t or "").encode() for t in texts)
    bad = spark.createDataFrame([(1, struct.pack("<2I", ranks[b"\xff"], ranks[b"a"]))], "row long, ids binary")
    assert bytes(bpe.decode(bad, ranks).first().data) == b"\xffa"


def test_empty_table(spark, ranks):
    assert bpe.encode(frame(spark, []), ranks, public_tokenizers.PATTERN).count() == 0


def test_whole_table(spark, ranks, reference):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op2_bpe(spark, "/root/testdata/sf0.01").collect()}
    want = {}
    for d in docs:
        ids = reference.encode_ordinary(d.text)
        want[d.doc_id] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(d.text.encode()).hexdigest())
    assert got == want


def test_short_and_long_merges_agree_and_a_full_store_keeps_what_is_asked_for(monkeypatch):
    import random

    from ledgerloom.llm import bpe

    ranks, _ = bpe.public_bpe()
    rng = random.Random(2)
    for _ in range(400):
        piece = "".join(rng.choice("aeinorst zä€1") for _ in range(rng.randint(1, 32))).encode()
        scanned = bpe.merge(piece, ranks)
        monkeypatch.setattr(bpe, "SCANNED_BYTES", 0)
        assert bpe.merge(piece, ranks) == scanned
        monkeypatch.undo()
    monkeypatch.setattr(bpe, "KEPT_PIECES", 5)
    encode = bpe.PieceEncoder(ranks)
    want = bpe.PieceEncoder(ranks)["often"]
    for i in range(40):
        assert encode[f"word{i}"] and encode["often"] == want
        assert len(encode) <= 5 and len(encode.older) <= 5


def test_row_numbers_hold_when_the_splits_change(spark, tmp_path):
    """Splits that differ between the call and the reading must not part a long text from its own columns."""
    from ledgerloom.llm import bpe

    ranks, pattern = bpe.public_bpe()
    docs = [(i, f"text {i} " * (900 if i % 3 == 0 else 3)) for i in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(6).write.parquet(str(tmp_path / "d"))
    encoded = bpe.encode(spark.read.parquet(str(tmp_path / "d")), ranks, pattern, keep=("doc_id",), chunk=2000, overlap=200, digests=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = encoded.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    tokens = bpe.tokens_of(ranks)
    assert {r.doc_id: bpe.decode_ids(r.ids, tokens).decode() for r in rows} == dict(docs) and len(rows) == 60
