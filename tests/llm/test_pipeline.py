import hashlib
import struct

import pytest
import tiktoken
from test_decontamination import brute as contaminated
from test_lines import brute as repeated
from test_simhash import fingerprint, groups

import corpus_pipeline as C
from ledgerloom.llm import bpe, toxicity

PATH = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage, the first being the input."""
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    out = [docs]
    for name, stage in C.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], PATH).write.parquet(path)
        out.append(spark.read.parquet(path))
    assert all(df.columns == docs.columns for df in out[:-1])
    return [df.collect() for df in out]


def test_toxic_documents_go(spark, stages):
    said = {r.doc_id for r in toxicity.op5_toxicity(spark, PATH).collect() if r.predicted}
    assert said
    assert sorted(stages[1]) == sorted(r for r in stages[0] if r.doc_id not in said)


def test_repeated_lines_go(stages):
    docs = [(r.doc_id, r.text) for r in stages[1]]
    gone = repeated(docs)
    want = {d: "\n".join(x for n, x in enumerate(t.split("\n")) if (row, n) not in gone) for row, (d, t) in enumerate(docs)}
    assert {r.doc_id: r.text for r in stages[2]} == want
    assert all(r.n_chars == len(r.text) for r in stages[2])
    assert len(stages[2]) == len(stages[1])


def test_one_of_each_group_stays(stages):
    docs = stages[2]
    component = groups([(r.doc_id, fingerprint(r.text)) for r in docs])
    assert sorted(stages[3]) == sorted(r for r, c in zip(docs, component) if r.doc_id == c)


def test_contaminated_documents_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{PATH}/benchmark.parquet").collect()]
    sample = [r for r in stages[3] if len(r.text) < 3000]
    found = {d for d, _ in contaminated([(r.doc_id, r.text) for r in sample], items)}
    kept = {r.doc_id for r in stages[4]}
    assert {r.doc_id for r in sample} - kept == found
    assert found


def test_tokens(stages):
    ranks, pattern = bpe.public_bpe()
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in stages[4]}
    assert {r.doc_id for r in stages[5]} == texts.keys()
    for r in stages[5]:
        ids = encoding.encode_ordinary(texts[r.doc_id])
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert (r.n_tokens, r.decoded_sha256) == (len(ids), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def test_run_is_the_stages_one_after_the_other(spark, stages):
    assert sorted(C.run(spark, PATH).collect()) == sorted(stages[5])


def test_what_a_stage_wrote_goes_when_the_next_is_written(spark):
    from pathlib import Path

    from ledgerloom.session import shared_dir

    def left(label):
        return set(Path(shared_dir(spark)).glob(f"ledgerloom/{label}-*"))

    labels = ["numbered", "shared", "line-texts", "places", *(f"pipeline-{name}" for name, _ in C.STAGES[:-1])]
    before = {label: left(label) for label in labels}
    C.run(spark, PATH)
    assert {label: len(left(label) - before[label]) for label in labels} == dict.fromkeys(labels, 0) | {"numbered": 1, "pipeline-decontamination": 1}  # that of simhash
