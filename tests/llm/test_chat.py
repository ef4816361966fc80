import hashlib
import random

import pytest

from ledgerloom.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, window string, start int"


def expected(rows):
    """conv_id -> turns and assistant texts, in order."""
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "")):
        turns, learned = out.setdefault(conv, ([], []))
        turns.append((role or "", text or ""))
        if role == "assistant":
            learned.append(text or "")
    return out


def made(rng):
    bits = ["<|im_end|>\n", "<|im_start|>user\n", "\\", "</s>", "[INST]", "<", "|", "é🙂", "\n", "word ", "\\n", "<<SYS>>", "x" * 30]
    rows = []
    for conv in range(40):
        turn = rng.choice([0, 5])
        if rng.random() < 0.5:
            rows.append((conv, turn, "system", "be kind " * rng.choice([1, 3, 60])))
        for k in range(rng.randint(1, 30)):
            turn += rng.randint(1, 2)
            rows.append((conv, turn, rng.choice(["user", "assistant", "tool\nx<|"]), "".join(rng.choice(bits) for _ in range(rng.choice([0, 3, 10, 60])))))
    rows += [(99, t, "assistant" if t % 2 else "user", f"turn {t} " * 5) for t in range(700)] + [(None, 1, "user", None), (None, None, "system", "s"), (98, 1, None, ""), (98, 2, "assistant", "y" * 200_000)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def case(spark):
    rows = made(random.Random(3))
    return rows, C.windows(spark.createDataFrame([(*r, "w", 1) for r in rows], SCHEMA), budget=200, history=60, blocks=5).cache()


@pytest.fixture(scope="module")
def formatted(case):
    return case[1].collect()


def test_reads_back_whole(case):
    rows, df = case
    turns, learned = {}, {}
    for r in sorted(C.read_back(df).collect(), key=lambda r: r.window):
        turns.setdefault(r.conv_id, []).extend((t.role, t.text) for t in r.turns)
        learned.setdefault(r.conv_id, []).extend(r.learned)
    want = expected(rows)
    assert turns == {c: t for c, (t, _) in want.items()}
    assert {c: [x for x in l] for c, l in learned.items()} == {c: l for c, (_, l) in want.items()}


def test_windows_keep_the_budget_and_repeat_context(formatted):
    several = 0
    for r in formatted:
        assert r.over_budget == (r.n_tokens > 200)
        turns = r.text.split(C.END)[:-1]
        own = turns[r.context_turns :]
        assert own
        if r.over_budget:
            assert len(own) == 1 or turns[0].startswith("<|im_start|>system")
        if r.window:
            several += r.context_turns > 0
        for s in r.loss:
            assert r.text[: s.start].endswith("<|im_start|>assistant\n") and r.text[s.end :].startswith(C.END)
    assert several > 20


def test_system_turn_is_in_every_window(case, formatted):
    systems = {conv for conv, (turns, _) in expected(case[0]).items() if turns[0][0] == "system"}
    for r in formatted:
        assert (r.text.startswith("<|im_start|>system\n")) == (r.conv_id in systems)
        assert r.text.count("<|im_start|>system\n") <= 1


def digest(rows):
    out = {}
    for conv, (turns, learned) in expected(rows).items():
        said = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(learned)
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_digests(case):
    rows, df = case
    got = C.digests(C.read_back(df)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == digest(rows)
    assert len(got) == len(digest(rows))


def test_empty_table(spark):
    assert C.digests(C.read_back(C.windows(spark.createDataFrame([], SCHEMA)))).count() == 0


def test_whole_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    probe = "</s>[INST] ok [/INST]"
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.op3_chat(spark, path).collect()}
    assert got == digest(rows + [(-7, 0, "user", probe), (-7, 1, "assistant", probe)])
