import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.suffix_tree import DIVERGENCE, HOT_WEIGHT, LEAST_SEEN, STEPS, WEIGHTS, op13_suffix_tree, score

SCHEMA = "doc_id long, text string, learn boolean, chunk int, tokens string, train int"
SF = "/root/testdata/sf0.001"


def tokens_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\v\f\r":
        low = low.replace(blank, " ")
    return [w for w in low.split(" ") if w] + [None]


class Tree:
    """The same model from plain dictionaries: all contexts of all training texts at once."""

    def __init__(self, texts, depth):
        self.depth = depth
        self.counts = [Counter() for _ in range(depth + 1)]
        for text in texts:
            t = tokens_of(text)
            for i, w in enumerate(t):
                for k in range(min(i, depth) + 1):
                    self.counts[k][tuple(t[i - k : i]), w] += 1
        self.n, self.v = sum(self.counts[0].values()), len(self.counts[0])
        self.weights = {}
        for k in range(1, depth + 1):
            after = {}
            for (s, w), c in self.counts[k].items():
                after.setdefault(s, {})[w] = c
            for s, nexts in after.items():
                seen = sum(nexts.values())
                if seen < LEAST_SEEN or k > 1 and s[1:] not in self.weights:
                    continue
                parent = {w: 10 ** (self.of(s[1:], w) if k == 1 else round(self.of(s[1:], w) * STEPS) / STEPS) for w in nexts}
                gains = {x: sum(c * math.log((max(c - 1, 0) + x * parent[w]) / (seen - 1 + x) / parent[w]) for w, c in nexts.items()) for x in WEIGHTS}
                best = max(WEIGHTS, key=lambda x: gains[x])
                if gains[best] > DIVERGENCE:
                    self.weights[s] = (best, seen)

    def base(self, w):
        return math.log10((self.counts[0][(), w] + 1) / (self.n + self.v + 1))

    def of(self, s, w):
        if not s:
            return self.base(w)
        weight, seen = self.weights[s]
        return math.log10((self.counts[len(s)][s, w] + weight * 10 ** self.of(s[1:], w)) / (seen + weight))

    def score(self, text):
        t, total, lengths = tokens_of(text), 0.0, 0
        for i, w in enumerate(t):
            s = max((tuple(t[i - k : i]) for k in range(min(i, self.depth) + 1) if not k or tuple(t[i - k : i]) in self.weights), key=len)
            total, lengths = total + self.of(s, w), lengths + len(s)
        return total, lengths / len(t)


def sample(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["Über", "A", "a", "b|"]
    texts = []
    for _ in range(n):
        text, at = [], 0
        for _ in range(rng.randrange(60)):
            at = (at * 7 + rng.choice([1, 1, 1, 2, rng.randrange(34)])) % 34
            text.append(words[at])
        texts.append(rng.choice([" ", "\n", " \t"]).join(text))
    return texts


def rows_of(spark, texts, **options):
    docs = [(i, t, i % 4 != 1, 1, "clash", 0) for i, t in texts]
    return score(spark.createDataFrame(docs, SCHEMA).repartition(3), F.col("learn"), **options).collect()


@pytest.mark.parametrize("depth, chunk_tokens", [(1, 1_000_000), (2, 500), (3, 2_000)])
def test_scores_are_those_of_a_tree_in_dictionaries(spark, depth, chunk_tokens):
    texts = list(enumerate(sample(depth, 150)))
    texts += [(900, None), (901, ""), (902, " \n"), (903, "new words only"), (904, "a A a " * 3000)] + [(908, texts[8][1])] * 12
    tree = Tree([t for i, t in texts if i % 4 != 1], depth)
    assert any(len(s) == depth for s in tree.weights)
    rows = rows_of(spark, texts, depth=depth, chunk_tokens=chunk_tokens)
    want = sorted((i, i % 4 != 1, len(tokens_of(t)), sum(tree.counts[0][(), w] > 0 for w in tokens_of(t))) for i, t in texts)
    assert sorted((r.doc_id, r.train, r.n_tokens, r.n_known) for r in rows) == want
    of = dict(texts)
    for r in rows:
        assert r.train_tokens == tree.n
        assert r.base_score == pytest.approx(sum(map(tree.base, tokens_of(of[r.doc_id]))), abs=1e-6)
        total, length = tree.score(of[r.doc_id])
        assert r.score == pytest.approx(total, abs=1e-3) and r.mean_context == pytest.approx(length)


def test_distributions_sum_to_one(spark):
    tree = Tree(sample(5, 200), 2)
    symbols = [w for _, w in tree.counts[0]]
    for s in [(), *list(tree.weights)[:40]]:
        unseen = 10 ** tree.of(s, "never seen")
        assert sum(10 ** tree.of(s, w) for w in symbols) + unseen == pytest.approx(1)


def test_hot_contexts_are_dealt_out_and_kept(spark):
    texts = [(i, " ".join(f"x y{j % 97}" for j in range(i, i + 80))) for i in range(0, 40, 2)]
    counts = Counter((a, b) for _, t in texts for a, b in zip(tokens_of(t), tokens_of(t)[1:]))
    seen, tree = sum(c for (a, _), c in counts.items() if a == "x"), Tree([t for _, t in texts], 0)
    rows = rows_of(spark, [*texts, (1, "x y5"), (5, "x z")], depth=1, hot_context=50)  # 1 and 5 are not learned from
    assert len(rows) == 22 and seen == 1600
    for doc_id, word in ((1, "y5"), (5, "z")):
        r = next(r for r in rows if r.doc_id == doc_id)
        own = math.log10((counts["x", word] + HOT_WEIGHT * 10 ** tree.base(word)) / (seen + HOT_WEIGHT))
        rest = r.score - tree.base("x") - own  # of the end, after a context that is not hot
        assert rest == pytest.approx(tree.base(None), abs=1e-4) if word == "z" else -6 < rest < 0


def test_empty_table_null_ids_and_nothing_to_learn_from(spark):
    assert score(spark.createDataFrame([], SCHEMA), F.col("learn")).count() == 0
    rows = score(spark.createDataFrame([(None, "a b", None, 1, "", 1), (None, "c", False, 1, "", 1)], SCHEMA), F.col("learn")).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows) == [(None, 2, 0, 0, 0.0, 0.0), (None, 3, 0, 0, 0.0, 0.0)]


def test_whole_table_scores_held_out_texts_better_than_the_base(spark):
    rows = op13_suffix_tree(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    train = Counter(w for i, t in docs.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in tokens_of(t))
    n, v = sum(train.values()), len(train)
    for r in rows:
        t = tokens_of(docs[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2, len(t), sum(train[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in t), abs=1e-6)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.02 * sum(r.n_tokens for r in held)


@pytest.mark.parametrize("depth, telling", [(1, False), (2, True)])
def test_results_do_not_depend_on_which_contexts_are_dealt(spark, depth, telling):
    rng = random.Random(3)
    if telling:  # x tells what follows, which is kept with another weight than that of untested contexts
        texts = [(2 * i, " ".join(f"x y{j % 97}" for j in range(i, i + 80))) for i in range(20)] + list(enumerate(sample(9, 60), 100))
    else:  # no word tells anything, however often it is seen
        texts = [(i, " ".join(rng.choice(["x", "u", "v", "w"]) for _ in range(80))) for i in range(60)]
    tree = Tree([t for i, t in texts if i % 4 != 1], depth)
    assert tree.weights[("x",)][0] != HOT_WEIGHT if telling else ("x",) not in tree.weights
    whole, dealt = (rows_of(spark, texts, depth=depth, chunk_tokens=700, **options) for options in ({}, {"dealt_context": 30}))
    of = dict(texts)
    assert len(whole) == len(dealt) == len(texts)
    for a, b in zip(sorted(whole), sorted(dealt)):
        total, length = tree.score(of[b.doc_id])
        assert a[:6] == b[:6] and b.score == pytest.approx(a.score, abs=1e-9)
        assert b.score == pytest.approx(total, abs=1e-3) and a.mean_context == b.mean_context == pytest.approx(length)
