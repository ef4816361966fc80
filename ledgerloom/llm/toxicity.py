"""Toxicity: noisy-channel deobfuscation of tokens, then a classifier on the restored words."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerloom.llm.common import PerTask, in_arrow, map_rows, query, table
from ledgerloom.session import settle

#: Labelled texts that the classifier learns from, chosen by the hash of the text: a bounded sample.
SAMPLE_TEXTS = 20_000
#: Features that training looks at, by how unevenly the sample's classes hold them.
FEATURES = 4_000
ROUNDS = 150
#: A feature must be held by so many sample texts of different wording.
LEAST_TEXTS = 4
THRESHOLD = 0.3
ORDER = 3
KEPT_TOKENS = 100_000
#: Words whose trigrams are counted in one array.
WORDS_AT_ONCE = 4_096
#: First letters by which a token is known to be unable to stand for a word that counts: those of the shortest beginnings.
LEADING = 3

# What a sign can stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c"}
#: Costs in nats, of the channel: a letter written as a sign, a letter put in between, a letter said once more, a sign
#: that stands for itself.
SIGN_COST, SEPARATOR_COST, REPEAT_COST, LITERAL_COST = 1.0, 0.5, 0.7, 4.0
#: A space that ends a word; below 0, as the run without any such end is read anyway.
BREAK_COST = -1.0

LETTER = re.compile(r"[^\W\d_]")
WORD = re.compile(r"[^\W\d_]+")
#: The model knows the Latin letters that signs can stand for and their accented neighbours; others count as one.
OTHER = re.compile("[^a-zß-öø-ÿ]")
SIGNS = "".join(LEET)
#: A token with a sign beside a letter, a letter twice in a row, or separators between letters.
NOISY = re.compile(rf"[^\W\d_][{re.escape(SIGNS)}]|[{re.escape(SIGNS)}][^\W\d_]|([^\W\d_])\1|[^\W\d_][\W_]+[^\W\d_]")
#: Single letters or signs in a row, spaced out; punctuation may stand at both ends.
SPACED = re.compile(rf"(?<!\w)(?:[^\W\d_]|[{re.escape(SIGNS)}])(?:[^\S\n]+(?:[^\W\d_]|[{re.escape(SIGNS)}])){{2,}}(?!\w)")
MARGINS = re.compile(r"^[^\w@$!|+€(]+|[^\w@$]+$")
#: What stands behind many words.
BEHIND = ".,;:?!%*&#$)'\""
#: Margins that leave the signs at the end, which may be punctuation or letters.
OUTER = re.compile(r"^[^\w@$!|+€(]+|[^\w@$!|+€(]+$")


def gram_counts(words: Counter) -> Counter:
    """Character trigrams of lower-cased words, with two word starts in front and one end behind."""
    counts: Counter = Counter()
    for start in range(0, len(words), WORDS_AT_ONCE):
        counts.update(_grams_at_once(list(islice(words, start, start + WORDS_AT_ONCE)), words))
    return counts


def _grams_at_once(some: list[str], words: Counter) -> dict[str, int]:
    """Trigrams of some words that stand one after the other as numbers; the letters the model knows have one byte."""
    letters = OTHER.sub("?", "".join(some))
    sizes = np.fromiter(map(len, some), np.int64, len(some))
    ends = np.cumsum(sizes + 3)
    signs = np.full(int(ends[-1]), ord("^"), np.uint32)
    signs[ends - 1] = ord("$")
    inside = np.arange(len(letters)) + np.repeat(3 * np.arange(len(some)) + 2, sizes)
    signs[inside] = np.frombuffer(letters.encode("utf-32-le"), np.uint32)
    starts = np.ones(len(signs), bool)
    starts[ends - 1] = starts[ends - 2] = False  # a word's last trigram begins two places before its end sign
    at = np.flatnonzero(starts)
    grams, which = np.unique(signs[at] << np.uint32(16) | signs[at + 1] << np.uint32(8) | signs[at + 2], return_inverse=True)
    times = np.repeat(np.fromiter(map(words.__getitem__, some), np.int64, len(some)), sizes + 1)
    counts = np.bincount(which, times).astype(np.int64)
    return {chr(g >> 16) + chr(g >> 8 & 255) + chr(g & 255): n for g, n in zip(grams.tolist(), counts.tolist())}


class CharModel:
    """Interpolated character trigrams."""

    def __init__(self, counts: dict[str, int]):
        self.three = counts
        self.context, self.two, self.middle, self.one = Counter(), Counter(), Counter(), Counter()
        for gram, n in counts.items():
            self.context[gram[:2]] += n
            self.two[gram[1:]] += n
            self.middle[gram[1]] += n
            self.one[gram[2]] += n
        self.total = sum(self.one.values())
        self.memory: dict[str, float] = {}

    def cost(self, gram: str) -> float:
        if (known := self.memory.get(gram)) is None:
            p = 0.7 * self.three.get(gram, 0) / max(1, self.context[gram[:2]])
            p += 0.25 * self.two[gram[1:]] / max(1, self.middle[gram[1]])
            p += 0.049 * self.one[gram[2]] / max(1, self.total) + 1e-5
            known = self.memory[gram] = -math.log(p)
        return known


def lattice(token: str) -> list[tuple[list[tuple[str, float]], bool]]:
    """Per stretch of the token: the letters it can stand for, each with its channel cost."""
    out, i = [], 0
    while i < len(token):
        c, j = token[i], i + 1
        while j < len(token) and token[j] == c:
            j += 1
        run = j - i
        if LETTER.match(c):
            # One or two letters meant, the rest said once more.
            options = [(c * k, REPEAT_COST * (run - k)) for k in (1, 2) if k <= run]
        elif c in LEET:
            letters = [(x * k, SIGN_COST * k + REPEAT_COST * (run - k)) for x in LEET[c] for k in (1, 2) if k <= run]
            options = [*letters, ("", LITERAL_COST * run)]
        elif c == " ":
            options = [("", 0.0), (" ", BREAK_COST)]
        else:
            options = [("", SEPARATOR_COST)]
        out.append(options)
        i = j
    return out


def restore(token: str, model: CharModel) -> str:
    """The likeliest word behind a lower-cased token: Viterbi over its lattice, the state being the last two letters.

    A space in the token is left out or parts two words, and then stands in the result.
    """
    states = {"^^": (0.0, "")}
    for options in lattice(token):
        following: dict[str, tuple[float, str]] = {}
        for state, (cost, text) in states.items():
            for letters, channel in options:
                total, at = cost + channel, state
                for letter in letters:
                    if letter == " ":
                        total += model.cost(at + "$")
                        at = "^^"
                    else:
                        total += model.cost(at + letter)
                        at = at[1] + letter
                if at not in following or (total, text + letters) < following[at]:
                    following[at] = (total, text + letters)
        states = following
    return min((cost + model.cost(state + "$"), text) for state, (cost, text) in states.items())[1]


def features_of(word: str) -> list[str]:
    return ["=" + word, *("^" + word[:n] for n in (3, 4, 5, 6) if len(word) > n)]


def can_begin(token: str, beginnings: set[str]) -> bool:
    """Whether any word that the token can stand for begins as one of some words does. ``beginnings`` holds the first
    letters of these, none to ``LEADING`` of them."""
    open_ones = {""}
    for options in lattice(token):
        open_ones = {start for known in open_ones for letters, _ in options if (start := (known + letters)[:LEADING]) in beginnings}
        if not open_ones:
            return False
    return True


class Reader(dict):
    """Lower-cased token to what is read from it: ``wanted`` of its words and of the word restored from it.

    With ``beginnings`` a token is decoded only if what comes out can be wanted, which changes no result.
    """

    def __init__(self, model: CharModel, wanted, beginnings: set[str] | None = None):
        super().__init__()
        self.model, self.wanted, self.beginnings = model, wanted, beginnings

    def __missing__(self, token: str) -> tuple[str, ...]:
        if self.beginnings is not None and self.plainly_unwanted(token):
            return self.keep(token, ())
        words = WORD.findall(token)
        for core in {MARGINS.sub("", token), OUTER.sub("", token)}:
            if not NOISY.search(core) or self.beginnings is not None and not can_begin(core, self.beginnings):
                continue
            if (restored := restore(core, self.model)) and restored not in words:
                words.append(restored)
        return self.keep(token, tuple(f for word in words for f in self.wanted(word)))

    def plainly_unwanted(self, token: str) -> bool:
        """Of most tokens, a word of letters alone with punctuation behind: whether neither it nor any word it can stand
        for begins as it should. All of these begin with its first three letters if no neighbours among them are the same."""
        word = token.rstrip(BEHIND)
        return word[:LEADING] not in self.beginnings and len(word) >= LEADING == 3 and word[0] != word[1] != word[2] and word.isalpha()

    def keep(self, token: str, found: tuple[str, ...]) -> tuple[str, ...]:
        if len(token) <= 64:
            if len(self) >= KEPT_TOKENS:
                self.clear()
            self[token] = found
        return found

    def read(self, text: str | None) -> set[str]:
        lowered = (text or "").lower()
        if not lowered.isascii():
            lowered = unicodedata.normalize("NFC", lowered)
        found = {f for token in set(lowered.split()) for f in self[token]}
        for spaced in {m.group() for m in SPACED.finditer(lowered)}:
            # As one word, also without a one-letter word at either end, and parted where the model says so.
            letters = spaced.split()
            whole = [letters, letters[1:], letters[:-1], letters[1:-1]]
            restored = {restore("".join(x), self.model) for x in whole if len(x) > 2 or x is letters}
            for word in restored.union(restore(" ".join(letters), self.model).split()):
                found.update(self.wanted(word))
        return found


def char_counts(texts: DataFrame) -> dict[str, int]:
    """Trigram counts over all texts. Tasks count and partial sums are shuffled; the alphabet bounds what comes back."""

    def run(batches):
        words: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                words.update(WORD.findall((text.as_py() or "").lower()))
                if len(words) > KEPT_TOKENS:
                    yield out(words)
                    words.clear()
        yield out(words)

    def out(words):
        counts = gram_counts(words)
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["gram", "n"])

    return dict(tuple(r) for r in in_arrow(texts, run, "gram string, n long").groupBy("gram").agg(F.sum("n")).collect())


def boost(rows: list[tuple[int, list[int]]], features: int) -> tuple[float, np.ndarray]:
    """Intercept and weights of a logistic model, by Newton steps on one feature at a time.

    The feature that explains most of what is left unexplained goes first, so one that merely occurs with it (other
    words of many near copies) gets little.
    """
    y = np.array([label for label, _ in rows], float)
    doc = np.repeat(np.arange(len(rows)), [len(f) for _, f in rows])
    feature = np.array([f for _, own in rows for f in own], np.int64)
    order = np.argsort(feature, kind="stable")
    doc, feature = doc[order], feature[order]
    starts = np.searchsorted(feature, np.arange(features + 1))
    prior = min(max(y.mean() if len(y) else 0.0, 1e-3), 1 - 1e-3)
    bias, weights = math.log(prior / (1 - prior)), np.zeros(features)
    total = np.full(len(y), bias)
    for _ in range(ROUNDS if features else 0):
        p = 1 / (1 + np.exp(-total))
        slope, bend = y - p, p * (1 - p)
        step = slope.sum() / (bend.sum() + 1)
        bias += step
        total += step
        p = 1 / (1 + np.exp(-total))
        slope, bend = y - p, p * (1 - p)
        up, down = np.bincount(feature, slope[doc], features), np.bincount(feature, bend[doc], features)
        gain = up * up / (down + 1)
        best = int(gain.argmax())
        if gain[best] < 2:
            break
        move = float(np.clip(up[best] / (down[best] + 1), -3, 3))
        weights[best] += move
        total[doc[starts[best] : starts[best + 1]]] += move
    return bias, weights


class Scorer:
    """What a task needs: the character model's counts, the intercept, the weight of each feature."""

    def __init__(self, grams: dict[str, int], bias: float, weights: dict[str, float]):
        self.grams, self.bias, self.weights = grams, bias, weights

    def reader(self) -> Reader:
        beginnings = {f[1 : 1 + n] for f in self.weights for n in range(LEADING + 1)}
        return Reader(CharModel(self.grams), lambda word: [f for f in features_of(word) if f in self.weights], beginnings)

    def score(self, reader: Reader, text: str | None) -> float:
        total = self.bias + sum(map(self.weights.__getitem__, sorted(reader.read(text))))
        return 1 / (1 + math.exp(-min(50.0, max(-50.0, total))))


def held_out(doc_id):
    """Whether a row's label is never learned from: crc32 of the id's text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Scorer:
    """A scorer: character counts of all texts, and a classifier from a sample of the labelled ones.

    Learns from ``SAMPLE_TEXTS`` labelled rows at most (by the hash of the id), never from held-out ones; equal
    texts count once. An id with several labels is toxic if one says so; null ids and labels are passed over.
    Without usable labels every text has the same low score.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    grams = char_counts(texts.select("text"))
    ids = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y is not null")
    ids = ids.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_TEXTS)
    sample = texts.join(F.broadcast(ids), "doc_id").groupBy(F.xxhash64("text").alias("name")).agg(F.max("y").alias("y"), F.min("text").alias("text"))

    def read():
        reader = Reader(CharModel(grams), lambda word: [word])

        def run(y, text):
            yield y, sorted({f for word in reader.read(text) for f in features_of(word)})

        return run

    sample = settle(map_rows(sample.select("y", "text"), PerTask(read), "y int, features array<string>"), "toxicity-sample")
    size, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not toxic or toxic == size:
        return Scorer(grams, -5.0 if not toxic else 0.0, {})
    counts = sample.select("y", F.explode("features").alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"))
    expected = F.col("n") * (toxic / size)
    uneven = (F.col("y") - expected) * (F.col("y") - expected) / (expected * (1 - toxic / size))
    chosen = [r.feature for r in counts.where(F.col("n") >= LEAST_TEXTS).orderBy(uneven.desc(), "feature").limit(FEATURES).collect()]
    number = {f: i for i, f in enumerate(chosen)}

    def pick(y, features):
        yield y, sorted(number[f] for f in features if f in number)

    rows = [(r.y, r.features) for r in map_rows(sample, pick, "y int, features array<int>").collect()]
    bias, weights = boost(rows, len(chosen))
    return Scorer(grams, bias, {f: float(w) for f, w in zip(chosen, weights) if w})


def with_score(docs: DataFrame, scorer: Scorer, name: str, text_col: str = "text") -> DataFrame:
    """``docs``, all columns and rows, with a column of scores between 0 and 1."""
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType(), False)])
    place = docs.columns.index(text_col)

    def run(batches):
        reader = scorer.reader()
        for batch in batches:
            scores = [scorer.score(reader, text.as_py()) for text in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=names)

    names = schema.names
    return in_arrow(docs, run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Columns doc_id, held_out, score, predicted, for every row; scores depend on the text alone.

    Tokens that may be disguised (signs or separators beside letters, letters repeated or spaced out) are decoded: a lattice of what
    each stretch can stand for, searched for the word likeliest under a character trigram model of all texts and a
    channel that makes signs, separators and repeats cost. A logistic model on words and word beginnings, plain and
    restored, scores the text. Null and empty texts score as texts without words. Null ids and repeated rows keep
    their rows; an empty table gives none; other columns are ignored.
    """
    scorer = learn(docs, labels, id_col, text_col, label_col)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = with_score(texts, scorer, "score")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@query("op5_toxicity")
def op5_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))
