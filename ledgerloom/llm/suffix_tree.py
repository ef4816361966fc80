"""Language model scoring with a probabilistic suffix tree over words, built and applied by exchanges of counts."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import in_arrow, query, setting, table
from ledgerloom.session import fresh_path

#: Words of a context at most.
DEPTH = 2
#: A context must have been seen so often to be tested.
LEAST_SEEN = 8
#: Gain of a context over its suffix, in nats over all that follows it, that keeps it.
DIVERGENCE = 6.0
#: Steps of a decade in which contexts of two and more words are told their suffix's probabilities, for the test alone.
STEPS = 256.0
#: Weights of the suffix's distribution that a context chooses from.
WEIGHTS = (1.0, 4.0, 16.0, 64.0, 256.0, 1024.0)
#: What follows a context seen more often than this is dealt over several groups, whose gains are added up for its test.
DEALT_CONTEXT = 1_000_000
#: The code of a context that the group itself cannot decide, as it holds a part of it.
UNDECIDED = 255
#: The weight of contexts that a caller wants kept untested.
HOT_WEIGHT = 256.0
#: Tokens of a chunk of documents, and keys of all chunks that one group counts; both bound a task's memory.
CHUNK_TOKENS, BUCKET_TOKENS = 1_000_000, 4_000_000
END = b""  # stands for the end of a text; no word is empty
CHUNKS = "chunk long, n_tokens long, doc_ids array<long>, train array<boolean>, ends array<long>, tokens binary, hashes binary, counts binary"
SENT = "chunk long, level int, bucket long, keys binary"
ANSWERS = "chunk long, level int, bucket long, counts binary, codes binary, train_tokens long, vocabulary long, parts array<struct<context:bigint,seen:bigint,gains:array<double>>>"
PARTS = pa.list_(pa.struct([("context", pa.int64()), ("seen", pa.int64()), ("gains", pa.list_(pa.float64()))]))
SCORES = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, mean_context double"

M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every bit of the result hangs on every bit given."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes, one after the other with their lengths. Equal places of the numbers' bytes stand
    together, so that the empty ones of small numbers cost nothing."""
    codec = pa.Codec("zstd", compression_level=1)
    out = []
    for array in arrays:
        planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T.tobytes()
        small = codec.compress(planes, asbytes=True)
        out.append(np.array([len(planes), len(small)], np.int64).tobytes() + small)
    return b"".join(out)


def unpacked(blob: bytes, *types) -> list[np.ndarray]:
    codec, at, out = pa.Codec("zstd"), 0, []
    for kind in map(np.dtype, types):
        size, small = np.frombuffer(blob, np.int64, 2, at).tolist()
        planes = np.frombuffer(codec.decompress(blob[at + 16 : at + 16 + small], size, asbytes=True), np.uint8)
        out.append(np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).reshape(-1))
        at += 16 + small
    return out


class Numbers(dict):
    """Numbers words in the order in which they are asked for."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def chunked(batches, chunk_tokens: int):
    """Documents (doc_id, train, text) as chunks of some million tokens: words numbered within the chunk, with their hashes
    and how often the chunk's training texts hold them. A longer document is a chunk of its own."""
    import xxhash

    def emptied():
        return Numbers({END: 0}), [], [], [], [], 0

    def chunk():
        hashes = mixed(np.fromiter(map(xxhash.xxh64_intdigest, local), np.uint64, len(local)))
        keys = word_keys(hashes, Groups(1, DEALT_CONTEXT))  # words take the numbers in whose order groups are sent them
        numbers = keys.at.astype(np.uint32)[np.concatenate(tokens)]
        learn = np.repeat(np.array(train, bool), np.diff(np.r_[0, ends]))
        counts = np.bincount(numbers[learn], minlength=len(keys.first)).astype(np.uint32)
        row = [uuid.uuid4().int >> 65, size, ids, train, ends, packed(numbers), packed(np.diff(keys.words, prepend=np.uint64(0))), packed(counts)]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    names = [f.split()[0] for f in CHUNKS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
    local, ids, train, ends, tokens, size = emptied()
    for batch in batches:
        for i in range(batch.num_rows):
            words = (batch.column(2)[i].as_py() or "").encode().lower().split()  # of bytes: A-Z only, and white space is \x20 and \x09-\x0D
            if size and size + len(words) >= chunk_tokens:
                yield chunk()
                local, ids, train, ends, tokens, size = emptied()
            tokens.append(np.fromiter((*map(local.__getitem__, words), 0), np.uint32, len(words) + 1))
            size += len(words) + 1
            ids.append(batch.column(0)[i].as_py())
            train.append(bool(batch.column(1)[i].as_py()))
            ends.append(size)
    if size:
        yield chunk()


@dataclass(frozen=True)
class Groups:
    """How many groups count keys, and from how many tokens behind it on a context is dealt over several."""

    number: int
    dealt: int

    def contexts(self, contexts: np.ndarray, words: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """What keys are grouped by: their context, of which a dealt one has several parts, by the word."""
        dealt = np.flatnonzero(seen > self.dealt)
        if len(dealt):
            contexts = contexts.copy()
            parts = (seen[dealt] // self.dealt + 1).astype(np.uint64)
            contexts[dealt] = mixed(contexts[dealt] ^ mixed(mixed(words[dealt]) % parts))
        return contexts

    def of(self, contexts: np.ndarray) -> np.ndarray:
        """The group of a context; it rises with the context, so keys by context are keys by group."""
        return ((contexts >> np.uint64(32)) * np.uint64(self.number) >> np.uint64(32)).astype(np.int64)


LOW24 = np.uint64((1 << 24) - 1)


class Keys:
    """The distinct (context, word) of a chunk's positions at one level, in the order in which groups are sent them."""

    def __init__(self, contexts, words, seen, groups: Groups):
        whole, contexts = contexts, groups.contexts(contexts, words, seen)
        # 40 bits of the context and 24 of the word tell keys apart like any 64 bits, and one sort gives the order.
        key = (contexts & ~LOW24) | (mixed(words) & LOW24)
        order = np.argsort(key)
        key = key[order]
        new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
        first = order[new]
        self.at = np.empty(len(order), np.int64)  # of a position: its key's place in the order
        self.at[order] = np.cumsum(new) - 1
        self.first = first  # of a key: one position
        self.contexts, self.words, self.seen, self.groups = contexts[first], words[first], seen[first], groups
        self.whole = whole[first]  # the context itself, of which a dealt one's key has a part

    def sent(self, level: int, counts: np.ndarray, parent: np.ndarray):
        """For each group: its number and the packed keys, with their counts and what gives their suffix's probability."""
        if not len(self.first):
            return
        bucket = self.groups.of(self.contexts)
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        for start, end in zip(starts, np.r_[starts[1:], len(bucket)]):
            words, own = self.words[start:end], counts[start:end].astype(np.uint32)
            if not level:
                yield int(bucket[start]), packed(np.diff(words, prepend=np.uint64(0)), own)
                continue
            contexts = self.contexts[start:end]
            runs = np.flatnonzero(np.r_[True, contexts[1:] != contexts[:-1]])
            lengths = np.diff(np.r_[runs, end - start]).astype(np.uint32)
            seen, whole = self.seen[start:end][runs], self.whole[start:end][runs]
            yield int(bucket[start]), packed(contexts[runs], lengths, seen, words, own, parent[start:end], whole[seen > self.groups.dealt])


def word_keys(hashes: np.ndarray, groups: Groups) -> Keys:
    """Level 0: words by themselves."""
    return Keys(hashes, hashes, np.zeros(len(hashes), np.int64), groups)


class Chunk:
    """A chunk's positions, and what the answers of the levels so far say about each."""

    def __init__(self, row: pa.Table, train_tokens: int, vocabulary: int, groups: Groups, decided: dict):
        get = {name: row[name][0].as_py() for name in ("doc_ids", "train", "ends", "tokens")}
        self.ids, self.train, self.ends = get["doc_ids"], np.array(get["train"], bool), np.array(get["ends"], np.int64)
        (self.tokens,) = unpacked(get["tokens"], np.uint32)
        starts = np.r_[0, self.ends[:-1]]
        sizes = self.ends - starts
        self.learn = np.repeat(self.train, sizes)
        self.offset = np.arange(len(self.tokens)) - np.repeat(starts, sizes)
        self.totals, self.groups, self.decided = (train_tokens, vocabulary), groups, decided
        self.level = 0
        self.context = np.zeros(len(self.tokens), np.uint64)
        self.depth = np.zeros(len(self.tokens), np.int8)

    def learn_words(self, answers: dict) -> None:
        counts = joined(answers, "counts", np.uint32)
        self.words = joined(answers, "codes", np.uint64)[self.tokens]
        self.known = counts[self.tokens].astype(np.int64)  # how often training texts hold the word
        self.base = np.log10(plain(counts, *self.totals))[self.tokens]
        self.value = self.base.copy()
        self.seen = self.known  # how often the key that ends at a position was seen: the next one's context

    def next_keys(self) -> tuple[Keys, np.ndarray]:
        """The keys one word deeper, and their positions: those whose suffix was kept and whose context was seen enough."""
        self.level += 1
        behind = np.zeros_like(self.words)
        behind[self.level :] = self.words[: -self.level]
        self.context = mixed(self.context * M2 + behind + np.uint64(1))
        seen = np.zeros(len(self.words), np.int64)
        seen[1:] = self.seen[:-1]
        at = np.flatnonzero((self.offset >= self.level) & (self.depth == self.level - 1) & (seen >= LEAST_SEEN))
        return Keys(self.context[at], self.words[at], seen[at], self.groups), at

    def asked(self) -> list[tuple[int, bytes]]:
        """The keys of the next level, packed for their groups."""
        keys, at = self.next_keys()
        counts = np.bincount(keys.at[self.learn[at]], minlength=len(keys.first))
        parent = self.known[at[keys.first]].astype(np.uint32) if self.level == 1 else np.round(self.value[at[keys.first]] * -STEPS).astype(np.uint16)
        return list(keys.sent(self.level, counts, parent))

    def learn_level(self, answers: dict) -> None:
        keys, at = self.next_keys()
        seen = self.seen
        self.seen = np.zeros(len(self.words), np.int64)
        if not len(at):
            return
        counts, codes = joined(answers, "counts", np.uint32)[keys.at], joined(answers, "codes", np.uint8)
        dealt = np.flatnonzero(codes == UNDECIDED)
        if len(dealt):
            contexts, chosen_codes = self.decided[self.level]
            codes = codes.copy()
            codes[dealt] = chosen_codes[np.searchsorted(contexts, keys.whole[dealt])]
        codes = codes[keys.at]
        self.seen[at] = counts
        kept = codes > 0
        at, counts = at[kept], counts[kept].astype(np.float64)
        weight, before = np.array(WEIGHTS)[codes[kept] - 1], seen[at - 1]
        self.value[at] = np.log10((counts + weight * 10.0 ** self.value[at]) / (before + weight))
        self.depth[at] = self.level

    def scores(self) -> pa.Table:
        def per_doc(values):
            return np.add.reduceat(values, np.r_[0, self.ends[:-1]])

        n = np.diff(np.r_[0, self.ends])
        return pa.table({
            "doc_id": pa.array(self.ids, pa.int64()), "train": pa.array(self.train), "n_tokens": pa.array(n), "n_known": pa.array(per_doc((self.known > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(n), self.totals[0])), "base_score": pa.array(per_doc(self.base)), "score": pa.array(per_doc(self.value)),
            "mean_context": pa.array(per_doc(self.depth.astype(np.float64)) / n),
        })


def joined(answers: dict, name: str, kind) -> np.ndarray:
    """The answers of all groups, in the order in which the keys were sent."""
    return np.concatenate([unpacked(answers[b][name], kind)[0] for b in sorted(answers)])


def answered(rows: pa.Table) -> dict[int, dict[int, dict]]:
    out: dict[int, dict[int, dict]] = {}
    for row in rows.select(["level", "bucket", "counts", "codes"]).to_pylist():
        out.setdefault(row["level"], {})[row["bucket"]] = row
    return out


def plain(counts: np.ndarray, train_tokens: int, vocabulary: int) -> np.ndarray:
    """The base: add-one over single tokens."""
    return (counts + 1.0) / (train_tokens + vocabulary + 1.0)


def sorted_keys(contexts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by context and word, and where a new context and a new key start in it."""
    order = np.argsort(contexts)
    by_context = contexts[order]
    new = np.r_[True, by_context[1:] != by_context[:-1]]
    if words.max() >> np.uint64(32):
        order = np.lexsort((words, contexts))
    else:  # one number for both
        order = order[np.argsort(np.cumsum(new).astype(np.uint64) << np.uint64(32) | words[order])]
    by_word = words[order]
    return order, new, new | np.r_[True, by_word[1:] != by_word[:-1]]


def counted(level: int, groups: Groups, totals: tuple[int, int]):
    """A group's keys of all chunks: counts, sent back to each chunk in its own order, with the numbers of the words at
    level 0, and with the code of the context's weight, 0 if it is not kept, from level 1 on. Of a dealt context the
    group has a part, and tells its gains instead."""

    def count(group: pa.Table) -> pa.Table:
        bucket, blobs = group["bucket"][0].as_py(), group["keys"].to_pylist()
        if level:
            last = np.uint32 if level == 1 else np.uint16
            parts = [unpacked(b, np.uint64, np.uint32, np.int64, np.uint64, np.uint32, last, np.uint64) for b in blobs]
            contexts = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
            seen = np.concatenate([np.repeat(p[2], p[1]) for p in parts])
            words, parent = np.concatenate([p[3] for p in parts]), np.concatenate([p[5] for p in parts])
            counts = [p[4] for p in parts]
            order, new_context, new_key = sorted_keys(contexts, words)
        else:
            parts = [unpacked(b, np.uint64, np.uint32) for b in blobs]
            words, counts = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]), [p[1] for p in parts]
            order = np.argsort(words)
            new_key = np.r_[True, words[order][1:] != words[order][:-1]]
        starts = np.flatnonzero(new_key)
        total = np.add.reduceat(np.concatenate(counts).astype(np.int64)[order], starts)
        told = []
        if level:
            first = order[starts]
            p = plain(parent[first], *totals) if level == 1 else 10.0 ** (parent[first] / -STEPS)
            context = np.cumsum(new_context)[starts] - 1
            gained = gains(context, total, seen[first], p)
            chosen_codes = chosen(gained)
            firsts = first[np.flatnonzero(np.r_[True, context[1:] != context[:-1]])]
            dealt = np.flatnonzero(seen[firsts] > groups.dealt)
            chosen_codes[dealt] = UNDECIDED
            codes = chosen_codes[context]
            whole = {part: own for q in parts for part, own in zip(q[0][q[2] > groups.dealt].tolist(), q[6].view(np.int64).tolist())}
            told = [{"context": whole[int(contexts[firsts[k]])], "seen": int(seen[firsts[k]]), "gains": gained[k].tolist()} for k in dealt]
        else:
            codes = np.arange(len(total), dtype=np.uint64) * np.uint64(groups.number) + np.uint64(bucket)
        key_of = np.empty(len(order), np.int64)
        key_of[order] = np.cumsum(new_key) - 1
        own = np.split(key_of, np.cumsum([len(c) for c in counts])[:-1])
        first_row = [k == 0 for k in range(len(own))]
        return pa.table({
            "chunk": group["chunk"], "level": pa.array([level] * len(own), pa.int32()), "bucket": group["bucket"],
            "counts": pa.array([packed(np.minimum(total[k], 0xFFFFFFFF).astype(np.uint32)) for k in own], pa.binary()),
            "codes": pa.array([packed(codes[k]) for k in own], pa.binary()),
            "train_tokens": pa.array([int(total.sum()) if f else 0 for f in first_row], pa.int64()),
            "vocabulary": pa.array([int((total > 0).sum()) if f else 0 for f in first_row], pa.int64()),
            "parts": pa.array([told if f else [] for f in first_row], PARTS),
        })

    return count


def gains(context: np.ndarray, counts: np.ndarray, seen: np.ndarray, p: np.ndarray) -> np.ndarray:
    """For contexts 0, 1, ..., to which the keys belong: the gain over their suffix under each weight.

    ``p`` is the suffix's probability of the word. Each symbol is left out in turn: a gain over the own counts would
    always be there. Gains are sums over the symbols, so those of a dealt context's parts add up.
    """
    held = np.flatnonzero(counts)
    own, counts, behind, p = context[held], counts[held], seen[held] - 1.0, p[held]
    n = int(context[-1]) + 1
    return np.stack([np.bincount(own, weights=counts * np.log((counts - 1 + w * p) / ((behind + w) * p)), minlength=n) for w in WEIGHTS], axis=1)


def chosen(gained: np.ndarray) -> np.ndarray:
    """The number of the weight that each context chose, counted from 1; 0 if none beats its suffix by the divergence."""
    return np.where(gained.max(axis=1) > DIVERGENCE, gained.argmax(axis=1) + 1, 0).astype(np.uint8)


def decisions(answers: DataFrame, hot: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The dealt contexts, ascending, and their codes, from the gains of all their parts. There is less than one of
    them for every ``DEALT_CONTEXT`` tokens of the corpus. Decimals, as their sum does not depend on its order."""
    sums = [F.sum(F.col("gains")[k].cast("decimal(38,9)")).cast("double").alias(f"g{k}") for k in range(len(WEIGHTS))]
    found = answers.selectExpr("inline(parts)").groupBy("context").agg(F.max("seen").alias("seen"), *sums).toArrow()
    contexts, seen = found["context"].to_numpy().view(np.uint64), found["seen"].to_numpy()
    codes = chosen(np.stack([found[f"g{k}"].to_numpy() for k in range(len(WEIGHTS))], axis=1)) if len(contexts) else np.zeros(0, np.uint8)
    if hot is not None:
        codes[seen > hot] = WEIGHTS.index(HOT_WEIGHT) + 1
    order = np.argsort(contexts)
    return contexts[order], codes[order]


def _written(df: DataFrame, label: str, rows: int = 0) -> DataFrame:
    """As ``settle``, with so many rows a file at most, and without keeping the shuffle's files."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.option("maxRecordsPerFile", rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, chunk_tokens: int = CHUNK_TOKENS, hot_context: int | None = None, dealt_context: int = DEALT_CONTEXT) -> DataFrame:
    """Columns doc_id, train, n_tokens, n_known, train_tokens, base_score, score, mean_context of every row.

    Tokens are the words of the text (A-Z lower-cased, parted by ASCII white space) and one end. Rows for which
    ``train`` is true are learned from (null: not). The base is add-one over single tokens. The tree's contexts are the
    one to ``depth`` words before a token, within its text; each, if its own suffix was kept, was seen ``LEAST_SEEN``
    times and diverges from that suffix, is a state with the smoothed distribution of ``smoothed``, and a token is
    scored by the longest state that fits; ``mean_context`` is that state's mean length in words. Distributions sum to
    one with the base's share for unseen words. Null and empty texts are one end; a null id is kept; repeated rows
    count each time; without training rows every token has probability 1. Other columns are ignored.

    Texts are read once, into chunks of a million tokens. A chunk sends each distinct key once, with its count, to the
    group of the key's context; the group adds up all chunks' counts, tests and smooths, and answers every chunk.
    Words and contexts are known by 64-bit hashes. A context seen more than ``dealt_context`` times is dealt over
    several groups, by the word; its test adds up the gains of them all, so it is the test of any other context. What
    is gathered grows with the corpus, and no table of it is broadcast or collected: the driver sees two sums and, for
    a dealt context, its code. Only if ``hot_context`` is given, contexts seen more often are kept untested, with ``HOT_WEIGHT``.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).cast("string").alias("text"))
    chunks = _written(in_arrow(rows, lambda batches: chunked(batches, chunk_tokens), CHUNKS), "suffix-chunks", rows=8)
    tokens = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    groups = Groups(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // BUCKET_TOKENS)), dealt_context if hot_context is None else min(dealt_context, hot_context))
    decided: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    sent_types = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def sent(row: pa.Table, level: int, asked) -> pa.Table:
        chunk = row["chunk"][0].as_py()
        rows = [(chunk, level, bucket, blob) for bucket, blob in asked]
        columns = zip(*rows) if rows else [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, sent_types)], names=["chunk", "level", "bucket", "keys"])

    def words(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = pa.Table.from_batches([batch.slice(i, 1)])
                (hashes,), (counts,) = unpacked(row["hashes"][0].as_py(), np.uint64), unpacked(row["counts"][0].as_py(), np.uint32)
                hashes = np.cumsum(hashes, dtype=np.uint64)
                yield from sent(row, 0, word_keys(hashes, groups).sent(0, counts, counts)).to_batches()

    def replayed(row: pa.Table, rows: pa.Table, totals: tuple[int, int], levels: int) -> Chunk:
        """The chunk after it heard the answers of the words and of some levels."""
        found = answered(rows)
        chunk = Chunk(row, *totals, groups, decided)
        chunk.learn_words(found[0])
        for level in range(1, levels + 1):
            chunk.learn_level(found.get(level, {}))
        return chunk

    def exchange(keys: DataFrame, level: int, totals: tuple[int, int] = (0, 0)) -> DataFrame:
        return _written(keys.groupBy("bucket").applyInArrow(counted(level, groups, totals), ANSWERS), "suffix-answers")

    answers = exchange(in_arrow(chunks, words, SENT), 0)
    totals = tuple(x or 0 for x in answers.agg(F.sum("train_tokens"), F.sum("vocabulary")).first())

    def heard():
        told = answers.select("chunk", "level", "bucket", "counts", "codes")
        return chunks.drop("counts", "hashes").groupBy("chunk").cogroup(told.groupBy("chunk"))

    def asking(level: int):
        def ask(row: pa.Table, rows: pa.Table) -> pa.Table:
            return sent(row, level, replayed(row, rows, totals, level - 1).asked())

        return ask

    for level in range(1, depth + 1):
        told = exchange(heard().applyInArrow(asking(level), SENT), level, totals)
        decided[level] = decisions(told, hot_context)
        answers = answers.unionByName(told)
    return heard().applyInArrow(lambda row, rows: replayed(row, rows, totals, depth).scores(), SCORES)


@query("op13_suffix_tree")
def op13_suffix_tree(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    rows = score(docs, ~F.coalesce(held_out, F.lit(False)))
    return rows.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "mean_context")
