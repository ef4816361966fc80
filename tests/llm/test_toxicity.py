import random
import zlib

import pytest

from ledgerloom.llm import toxicity as T

DOCS, LABELS = "doc_id long, text string, score double, lang string", "doc_id long, toxic int, quality int"
BAD = ["idiot", "moron", "scum", "loser", "stupid"]


@pytest.fixture(scope="module")
def model():
    from collections import Counter

    words = Counter({w: 40 for w in BAD} | {w: 60 for w in "the and of this that person with these words there student list stop trip some morning other close".split()})
    return T.CharModel(dict(T.gram_counts(words)))


@pytest.mark.parametrize("token", ["1d10t", "id!ot", "iiidiot", "i.d.i.o.t", "m0r0n", "$cum", "l0seeer", "5tup1d", "stuuupid"])
def test_restores_the_word(model, token):
    assert T.restore(token, model) in BAD


@pytest.mark.parametrize("text", ["i d i o t.", "(i d i o t)", "i d i o t,", "a i d i o t", "iidiioott", "stuupid", "1d107", "idio7", "idio+", "5(um", "id-iot", "sc*um", "id.iot", "l o o o s e r"])
def test_disguises_reach_the_decoder(text):
    from collections import Counter

    words = {w: 40 for w in BAD} | {w: 60 for w in "the and of this that person with these words there student list stop trip some morning".split()}
    model = T.CharModel(dict(T.gram_counts(Counter(words | {"a": 200}))))
    assert T.Reader(model, lambda word: [word]).read(text) & set(BAD)


def test_spaced_words_are_parted(model):
    assert {"stupid", "idiot"} <= T.Reader(model, lambda word: [word]).read("you s t u p i d i d i o t!")


def test_viterbi_finds_the_cheapest_path(model):
    import itertools

    rng = random.Random(1)
    for _ in range(60):
        token = "".join(rng.choice("adiost10$!.") for _ in range(rng.randint(1, 6)))
        costs = []
        for path in itertools.product(*T.lattice(token)):
            word = "".join(p for p, _ in path)
            padded = f"^^{word}$"
            costs.append(sum(c for _, c in path) + sum(model.cost(padded[i : i + 3]) for i in range(len(padded) - 2)))
        word = T.restore(token, model)
        best = min(sum(c for _, c in path) + sum(model.cost(f"^^{word}$"[i : i + 3]) for i in range(len(word) + 1)) for path in itertools.product(*T.lattice(token)) if "".join(p for p, _ in path) == word)
        assert best == pytest.approx(min(costs))


def some_docs(rng, n):
    clean = ["river", "stone", "cloud", "window", "garden", "table", "music", "paper", "street", "winter"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(clean) for _ in range(rng.randint(3, 40))]
        toxic = rng.random() < 0.3
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(BAD)
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic), 1))
    return docs, labels


def test_learns_plain_and_catches_disguised_words(spark):
    docs, labels = some_docs(random.Random(6), 600)
    more = [(1000, "what a st00pid paper"), (1001, "you l 0 s e r of the garden"), (1002, "m.o.r.o.n"), (1003, None), (1004, ""), (None, "garden music"), (1005, "window " * 30_000 + "idiooot"), (1005, "garden music")]
    more[0] = (1000, "what a 5tup1d paper")
    df = spark.createDataFrame([(*d, 0.5, "en") for d in docs + more], DOCS)
    rows = T.toxicity(df, spark.createDataFrame(labels + [(None, 1, 1), (1, None, 1)], LABELS)).collect()
    assert len(rows) == len(docs) + len(more)
    truth = {i: y for i, y, _ in labels}
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    by_id = {r.doc_id: r.predicted for r in rows if r.doc_id != 1005}
    assert [by_id[i] for i in (1000, 1001, 1002, 1003, 1004, None)] == [1, 1, 1, 0, 0, 0]
    assert sorted(r.predicted for r in rows if r.doc_id == 1005) == [0, 1]


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "some text", 0.1, "x")], DOCS)
    assert [r.predicted for r in T.toxicity(docs, spark.createDataFrame([], LABELS)).collect()] == [0]
    assert T.toxicity(docs.limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_held_out_accuracy_on_the_table(spark):
    path = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    rows = [r for r in T.op5_toxicity(spark, path).collect() if r.held_out and r.doc_id in truth]
    hits = sum(r.predicted and truth[r.doc_id] for r in rows)
    assert hits >= 0.8 * sum(truth[r.doc_id] for r in rows)
    assert hits >= 0.85 * sum(r.predicted for r in rows)


def test_tokens_that_cannot_count_are_left_alone_without_a_difference():
    import random
    from collections import Counter

    from ledgerloom.llm import toxicity as T

    words = ["idiot", "stupid", "trash", "is", "a", "moron", "letter", "apple", "green", "street", "ugly", "scum"]
    grams = dict(T.gram_counts(Counter({w: 50 for w in words})))
    weights = {"=idiot": 1.0, "^stu": 1.0, "=ugly": 1.0, "^scu": 0.5, "=a": 0.1, "^mor": 1.0}
    scorer = T.Scorer(grams, 0.0, weights)
    wanted = lambda word: [f for f in T.features_of(word) if f in weights]
    quick, full = scorer.reader(), T.Reader(T.CharModel(grams), wanted)
    rng = random.Random(4)
    written = {"i": "i1!|", "o": "o0", "s": "s5$", "a": "a4@", "t": "t7+", "e": "e3", "g": "g69", "c": "c("}
    tokens = set()
    for _ in range(3000):
        word = "".join(rng.choice(written.get(c, c)) * rng.choice([1, 1, 1, 2, 3]) for c in rng.choice(words))
        tokens.add(rng.choice(["", "(", "$"]) + rng.choice(["", ".", "-", "*"]).join([word[: len(word) // 2], word[len(word) // 2 :]]) + rng.choice(["", ".", "!", ","]))
    found = {t: full[t] for t in tokens}
    assert {t: quick[t] for t in tokens} == found and sum(map(bool, found.values())) > 500
    assert sum(T.can_begin(t, quick.beginnings) for t in tokens) < len(tokens)


def test_words_that_plainly_count_for_nothing_are_not_decoded(monkeypatch):
    calls = []
    own = T.lattice
    monkeypatch.setattr(T, "lattice", lambda token: calls.append(token) or own(token))
    rng = random.Random(5)
    letters, signs = "idotabenß", "idotabe0!1.$* -"
    tokens = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) + rng.choice(["", ".", "!!", "$$$", "&&", "-idiot", "1"]) for _ in range(3000)]
    tokens += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 9))).replace(" ", "") for _ in range(3000)]
    scorer = T.Scorer({"^^i": 9, "^id": 9, "idi": 9, "dio": 9, "iot": 9, "ot$": 9}, 0.0, {"=idiot": 1.0, "^nota": 1.0, "=be": 1.0})
    quick, plain = scorer.reader(), scorer.reader()
    plain.plainly_unwanted = lambda token: False
    assert [quick[t] for t in tokens] == [plain[t] for t in tokens] and sum(map(bool, map(plain.__getitem__, tokens))) > 20
    calls.clear()
    reader = scorer.reader()
    assert [reader[t] for t in ("batten!!", "donnable$$$", "tadaa,", "abeen")] == [()] * 4 and not calls


def test_trigrams_of_many_words_at_once():
    from collections import Counter

    rng = random.Random(6)
    words = Counter("".join(rng.choice("abé日²ÿZ") for _ in range(rng.randint(1, 6))) for _ in range(500))
    want = Counter()
    for word, n in words.items():
        padded = f"^^{T.OTHER.sub('?', word)}$"
        for i in range(len(padded) - 2):
            want[padded[i : i + 3]] += n
    assert T.gram_counts(words) == want and T.gram_counts(Counter()) == Counter()
