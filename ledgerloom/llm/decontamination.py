"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of the passages they point at."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import in_arrow, map_rows, query, table
from ledgerloom.llm.passages import Vocabulary, lookup, words_of

SEED_WORDS = 3
#: Least alignment score (matches minus mismatches and gaps) over the item's words: about one word in five edited.
LEAST_SCORE = 0.6
#: Items with fewer words must be found word for word.
EDITABLE_WORDS = 8
#: Bytes of benchmark text that are compared at once; this much, and no more, goes to every task.
BLOCK_BYTES = 4_000_000


def needed_score(words: int, least: float = LEAST_SCORE) -> int:
    return int(np.ceil(least * words - 1e-9)) if words >= EDITABLE_WORDS else words


def seeds_kept(words: int, least: float = LEAST_SCORE, length: int = SEED_WORDS) -> int:
    """How many of an item's rarest seeds of some words are enough: one more than the most that allowed edits can destroy.

    Losing score s by changed or missing words takes s / 2 edits, which destroy ``length`` seeds each; by words put in
    between, s edits, which destroy one less each. So no copy within the bound loses all of the kept seeds.
    """
    spare = words - needed_score(words, least)
    return max(spare // 2 * length, spare * (length - 1)) + 1


def seed_length(words: int, least: float = LEAST_SCORE) -> int:
    """Words of an item's seeds: three, or fewer if the item has not as many seeds as must be kept."""
    return next(n for n in range(SEED_WORDS, 0, -1) if n == 1 or words - n + 1 >= seeds_kept(words, least, n))


class Items:
    """The items of a block: word numbers, and seeds by length."""

    def __init__(self, rows: list[tuple], least: float = LEAST_SCORE):
        texts: dict[tuple, list] = defaultdict(list)
        for item_id, text in rows:
            if words := words_of(text):
                texts[tuple(words)].append(item_id)
        self.names = list(texts.values())
        self.vocabulary = Vocabulary(map(list, texts))
        self.words = [self.vocabulary.ids(list(t)) for t in texts]
        self.grams: dict[int, np.ndarray] = {}
        found = defaultdict(set)
        for ids in self.words:
            n = seed_length(len(ids), least)
            found[n].update(self.vocabulary.gram_codes(ids, n)[0].tolist())
        for n, codes in found.items():
            self.grams[n] = np.array(sorted(codes), np.int64)
        self.where: dict[int, dict[int, list[tuple[int, int]]]] = {}

    def keep_rarest(self, frequency: dict[tuple[int, int], int], least: float) -> None:
        """Seeds that stay, by the number of documents that hold them; ties go to the earlier seed."""
        where = defaultdict(lambda: defaultdict(list))
        for item, ids in enumerate(self.words):
            n = seed_length(len(ids), least)
            codes = self.vocabulary.gram_codes(ids, n)[0].tolist()
            order = sorted(range(len(codes)), key=lambda p: (frequency.get((n, codes[p]), 0), p))
            for p in order[: seeds_kept(len(ids), least, n)]:
                where[n][codes[p]].append((item, p))
        self.where = {n: dict(w) for n, w in where.items()}
        self.grams = {n: np.array(sorted(w), np.int64) for n, w in self.where.items()}


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: score, and start and end of its part of the passage. Match 1, mismatch -1, gap -1.

    A row at a time: gaps along the row are a running maximum. ``begin`` carries where the alignment of a cell began.
    """
    n = len(passage)
    above, begin_above = np.zeros(n + 1, np.int64), np.arange(n + 1)
    steps = np.arange(n + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = above[:-1] + np.where(passage == word, 1, -1)
        down = above[1:] - 1
        cell = np.maximum(diagonal, down)
        begin = np.where(diagonal >= down, begin_above[:-1], begin_above[1:])
        dead = cell <= 0
        cell[dead], begin[dead] = 0, steps[1:][dead]
        cell, begin = np.r_[0, cell], np.r_[0, begin]
        rank = (cell + steps) * (n + 2) + steps  # of equal ones the latest, as fewer gaps then
        source = np.maximum.accumulate(rank) % (n + 2)
        along = cell[source] - (steps - source)
        gap = along > cell
        cell, begin = np.where(gap, along, cell), np.where(gap, begin[source], begin)
        top = int(cell.argmax())
        if cell[top] > best[0]:
            best = (int(cell[top]), int(begin[top]), top)
        above, begin_above = cell, begin
    return best


def matches(items: Items, text: str | None, least: float):
    """(item number, score, start, end) of each item found in a text, at its best place; positions in words."""
    ids = items.vocabulary.ids(words_of(text))
    spans = defaultdict(list)
    for n, grams in items.grams.items():
        codes, at = items.vocabulary.gram_codes(ids, n)
        hit, _ = lookup(grams, codes)
        for q, code in zip(at[hit].tolist(), codes[hit].tolist()):
            for item, p in items.where[n][code]:
                spans[item].append(q - p)
    for item, diagonals in spans.items():
        own = items.words[item]
        needed = needed_score(len(own), least)
        room = len(own) - needed + 1  # gaps can move an alignment off its seed's diagonal by as much
        counts = np.bincount(own, minlength=len(items.vocabulary))
        windows: list[list[int]] = []
        for d in sorted(set(diagonals)):
            start, end = max(0, d - room), min(len(ids), d + len(own) + room)
            if windows and start <= windows[-1][1]:
                windows[-1][1] = end
            else:
                windows.append([start, end])
        best = (0, 0, 0)
        for start, end in windows:
            passage = ids[start:end]
            known = passage[passage >= 0]
            # Words in common, whatever their order, bound the score.
            if np.minimum(np.bincount(known, minlength=len(counts)), counts).sum() >= needed:
                score, a, b = align(own, passage)
                if score > best[0]:
                    best = (score, start + a, start + b)
        if best[0] >= needed:
            yield item, best[0] / len(own), best[1], best[2]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """Columns doc_id, item_id, score, start_word, end_word: a row for each item that a document holds a copy of.

    Score is that of the best local alignment over the item's words (1: word for word). Words are lower-cased runs
    of letters, digits and underscores. Every document is read twice: to count in how many documents each seed
    stands, then to find the rarest seeds of each item and align. No text is moved between tasks, however many
    documents share a passage. Seeds are rare for their item, not against a fixed limit, so an item that leaked
    into a third of all documents still has seeds, and enough are kept that no copy within the bound is missed. Items of
    fewer than ``EDITABLE_WORDS`` (8) words must be found word for word.
    A benchmark beyond ``BLOCK_BYTES`` is compared in blocks, each against all documents. Null and empty texts match
    nothing; items with equal words are reported each; repeated rows and null ids give rows of their own; empty
    tables give none; other columns are ignored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, score double, start_word long, end_word long")
    for items in _blocks(texts, benchmark, item_col, item_text_col, least):
        out = out.unionByName(_found(texts, items, least))
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns, that hold a copy of no item."""
    place, kept = docs.columns.index(text_col), docs
    for items in _blocks(docs.select(F.col(text_col).cast("string").alias("text")), benchmark, item_col, item_text_col, least):

        def clean(batches, items=items):
            for batch in batches:
                yield batch.filter(pa.array([next(matches(items, t.as_py(), least), None) is None for t in batch.column(place)], pa.bool_()))

        kept = in_arrow(kept, clean, docs.schema)
    return kept


def _blocks(texts: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, least: float) -> Iterator[Items]:
    """The benchmark in blocks of about ``BLOCK_BYTES``, each with the seeds that are rare in the texts."""
    questions = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    total = questions.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    for block in range(blocks):
        part = questions.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        items = Items([tuple(r) for r in part.collect()], least)
        items.keep_rarest(_frequency(texts, items), least)
        yield items


def _frequency(texts: DataFrame, items: Items) -> dict[tuple[int, int], int]:
    """In how many texts each seed of the block stands."""

    def count(batches):
        counts = {n: np.zeros(len(grams), np.int64) for n, grams in items.grams.items()}
        for batch in batches:
            for text in batch.column(0):
                ids = items.vocabulary.ids(words_of(text.as_py()))
                for n, grams in items.grams.items():
                    counts[n][np.unique(lookup(grams, items.vocabulary.gram_codes(ids, n)[0])[1])] += 1
        for n, c in counts.items():
            seen = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), n)), pa.array(items.grams[n][seen]), pa.array(c[seen])], names=["n", "code", "docs"])

    rows = in_arrow(texts.select("text"), count, "n long, code long, docs long").groupBy("n", "code").agg(F.sum("docs").alias("docs"))
    return {(r.n, r.code): r.docs for r in rows.collect()}  # a row for each seed of the block at most


def _found(texts: DataFrame, items: Items, least: float) -> DataFrame:
    def find(doc_id, text):
        for item, score, start, end in matches(items, text, least):
            for name in items.names[item]:
                yield doc_id, name, score, start, end

    return map_rows(texts, find, "doc_id long, item_id long, score double, start_word long, end_word long")


@query("op7_decontamination")
def op7_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
