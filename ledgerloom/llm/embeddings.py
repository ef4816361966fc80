"""Near-duplicate embeddings by spherical-cap filters of a structured product code."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import PerTask, by_group, components, group_roots, in_arrow, map_rows, query, table, tiled, with_row_id
from ledgerloom.session import settle

THRESHOLD = 0.93
#: Independent rotations, each with a code of its own, and the filters of a code that a pair at the threshold is
#: expected to share. Measured on random pairs at cosine 0.93 and 1,024 to 1,048,576 filters: at most one in 200
#: shares no filter of either code.
CODES, SHARED = 2, 6.0
#: Vectors of a label that a filter is expected to hold; the number of filters grows with the table to keep it so.
BUCKET_ROWS = 48
SMALLEST_WORDS = 512
TILE_ROWS = 1024
SEED = 20_240_601


def cap(filters: float, threshold: float = THRESHOLD, shared: float = SHARED, dims: int = 64) -> float:
    """Least inner product, in units of a random direction's spread, at which a vector belongs to a filter.

    Of ``filters`` directions a pair at ``threshold`` should exceed ``shared`` together; by the law of the sphere in
    ``dims`` dimensions. The normal law puts small caps too high, and the more filters the higher.
    """
    parts = 4000
    v = np.linspace(-1, 1, 20_001)
    below = np.cumsum((1 - v * v) ** ((dims - 4) / 2))
    below /= below[-1]
    whole = math.exp(math.lgamma((dims - 1) / 2) + math.lgamma(0.5) - math.lgamma(dims / 2))
    spread = math.sqrt(max(1e-12, 1 - threshold * threshold))

    def both(z: float) -> float:
        # The first vector's component x along the direction, then what the other's own part has to add.
        low = z / math.sqrt(dims)
        x = low + (1 - low) * (np.arange(parts) + 0.5) / parts
        density = (1 - x * x) ** ((dims - 3) / 2) / whole * (1 - low) / parts
        above = 1 - np.interp((low - threshold * x) / (spread * np.sqrt(1 - x * x)), v, below, left=0.0, right=1.0)
        return float((density * above).sum()) * filters

    low, high = 0.0, math.sqrt(dims)
    for _ in range(40):
        middle = (low + high) / 2
        low, high = (middle, high) if both(middle) > shared else (low, middle)
    return low


def plan(rows: int, labels: int) -> tuple[int, int]:
    """Code words per half, and one in how many of their combinations is a filter.

    Filters grow with the rows of a label. There are always 16 combinations or more to a filter: a whole product
    code has its filters in rows and columns that a vector exceeds together or not at all, a sparse one does not.
    """
    memberships = 1.6 * SHARED  # about 0.6 of a vector's filters are shared at the threshold
    filters = 2 ** max(10, math.ceil(math.log2(max(1.0, memberships * rows / max(1, labels) / BUCKET_ROWS))))
    words = max(SMALLEST_WORDS, 2 ** math.ceil(math.log2(4 * math.sqrt(filters))))
    return words, words * words // filters


def padded(dims: int) -> int:
    return max(64, 1 << (dims - 1).bit_length())


class ProductCode:
    """Directions (u + v) / sqrt 2 of code words u, v for the halves of a randomly rotated space; one in ``every`` is a filter."""

    def __init__(self, number: int, dims: int, words: int, every: int, z: float):
        rng = np.random.default_rng([SEED, number, dims, words])
        self.number, self.every = number, np.uint64(every)
        self.size = padded(dims)  # short vectors are padded: the cap is for many dimensions
        self.signs = rng.choice([-1.0, 1.0], (2, self.size))
        self.words = rng.standard_normal((2, words, self.size // 2))
        self.words /= np.linalg.norm(self.words, axis=2, keepdims=True)
        self.least = z / math.sqrt(self.size) * math.sqrt(2)

    def rotate(self, x: np.ndarray) -> np.ndarray:
        """Twice: random signs, then the Hadamard transform; n log n steps instead of a matrix."""
        x = np.pad(x, ((0, 0), (0, self.size - x.shape[1])))
        for signs in self.signs:
            x, h = x * signs, 1
            while h < self.size:
                x = x.reshape(len(x), -1, 2, h)
                x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), self.size)
                h *= 2
            x = x / math.sqrt(self.size)
        return x

    def is_filter(self, numbers: np.ndarray) -> np.ndarray:
        mixed = (numbers.astype(np.uint64) + np.uint64(self.number + 1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (mixed >> np.uint64(33)) % self.every == 0

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        """For each unit vector the sorted numbers of the filters it exceeds.

        List decoding: with the second half's words in falling order, those that go with a word of the first half
        are a prefix, found by binary search; no other combination is looked at.
        """
        half = self.size // 2
        rotated = self.rotate(x)
        first, second = rotated[:, :half] @ self.words[0].T, rotated[:, half:] @ self.words[1].T
        order = np.argsort(-second, axis=1)
        out = []
        for f, s, o in zip(first, second, order):
            counts = np.searchsorted(-s[o], f - self.least, side="right")
            chosen = np.flatnonzero(counts)
            numbers = np.concatenate([np.zeros(0, np.int64), *(c * len(s) + o[: counts[c]] for c in chosen)])
            out.append(np.sort(numbers[self.is_filter(numbers)]) * CODES + self.number)
        return out


def compare(filters: list, here: int, x: np.ndarray, weights: np.ndarray, parts: np.ndarray, cross: bool, threshold: float):
    """Links among the vectors of one filter that no smaller filter holds too: weighted counts and roots.

    A pair is counted at the smallest filter that both belong to, so no pair is counted twice and no list of pairs
    has to be moved and made distinct.
    """
    close = x @ x.T >= threshold
    np.fill_diagonal(close, False)
    if cross:
        close &= parts[:, None] != parts[None, :]
    if close.any():
        owner = np.repeat(np.arange(len(filters)), [len(f) for f in filters])
        flat = np.concatenate(filters)
        smaller = flat < here
        owner, flat = owner[smaller], flat[smaller]
        names, column = np.unique(flat, return_inverse=True)
        if len(names):
            member = np.zeros((len(filters), len(names)), np.float32)
            member[owner, column] = 1
            close &= member @ member.T == 0
    left, right = np.nonzero(close)
    return np.bincount(left, weights[right], len(x)).astype(np.int64), group_roots(len(x), left, right)


def _usable(label, vector) -> np.ndarray | None:
    """The vector with length 1 in double precision, or None if it links with nothing."""
    if label is None or not vector or any(v is None for v in vector):
        return None
    x = np.asarray(vector, np.float64)
    top = np.abs(x).max()
    if not np.isfinite(top) or top == 0:
        return None
    x = x / top
    return x / math.sqrt(float(x @ x))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """Columns vec_id, n_links, component_id, kept for every row.

    Vectors link if their labels are equal and not null, their lengths are equal and their cosine in double
    precision is ``threshold`` or more, as found by the filters and verified. Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing, and stand for themselves. Equal vectors of a label are
    compared once and weighted; each counts the others as links. Groups of a filter that are too large for a task
    are dealt into tiles. Null ids stay; a component without any id has a null component_id and is not kept.
    Repeated ids are rows of their own. An empty table gives no rows; other columns are ignored.

    The filters are random but fixed: a pair is missed only if it shares none of the filters it is expected to
    share ``SHARED`` of. tests/llm/test_embeddings.py measures the recall.
    """
    rows = with_row_id(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"), F.col(label_col).cast("string").alias("label")), "row")
    rows = settle(rows, "vectors")
    distinct = rows.where("label is not null and x is not null").groupBy("label", "x").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("weight"))
    size = rows.agg(F.count(F.lit(1)), F.count_distinct("label")).first()
    words, every = plan(*size)

    def decode():
        @lru_cache(maxsize=16)
        def codes(dims):
            z = cap(words * words / every, threshold, dims=padded(dims))
            return [ProductCode(number, dims, words, every, z) for number in range(CODES)]

        def run(node, weight, label, vector):
            x = _usable(label, vector)
            if x is not None:
                filters = np.sort(np.concatenate([code.decode(x[None, :])[0] for code in codes(len(x))]))
                yield node, weight, f"{len(x)}:{label}", vector, filters.tolist()

        return run

    kind = vectors.schema[vector_col].dataType.simpleString()
    found = map_rows(distinct.select("node", "weight", "label", "x"), PerTask(decode), f"node long, weight long, class string, x {kind}, filters array<long>")
    found = settle(found, "decoded")
    spread = found.select("node", "weight", "x", "filters", "class", F.explode("filters").alias("filter"))
    spread = spread.withColumn("key", F.xxhash64("class", "filter"))
    dealt = tiled(spread, "key", F.col("node"), TILE_ROWS).select("gid", "node", "weight", "filter", "part", "cross", "class", "filters", "x")

    def run(batches):
        for batch in by_group(batches):
            gids = batch.column(0).to_numpy()
            ends = np.r_[np.flatnonzero(gids[1:] != gids[:-1]) + 1, len(gids)]
            out = []
            for start, end in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist()):
                if end - start < 2:
                    continue
                group = batch.slice(start, end - start)
                nodes, weights, here, parts, cross, classes = (group.column(i).to_numpy(zero_copy_only=False) for i in range(1, 7))
                # The groups are hashes; should two collide, each is compared on its own.
                for name, f in {(c, int(f)) for c, f in zip(classes, here)}:
                    own = np.flatnonzero((classes == name) & (here == f))
                    if len(own) < 2:
                        continue
                    filters = [np.asarray(group.column(7)[int(i)].as_py()) for i in own]
                    x = np.array([_usable("", group.column(8)[int(i)].as_py()) for i in own])
                    links, roots = compare(filters, f, x, weights[own], parts[own], bool(cross[own[0]]), threshold)
                    out += [(int(nodes[own[i]]), int(links[i]), int(nodes[own[roots[i]]])) for i in np.flatnonzero(links)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["node", "links", "root"])

    linked = settle(in_arrow(dealt.repartition("gid").sortWithinPartitions("gid"), run, "node long, links long, root long"), "links")
    classes = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = distinct.join(found.select("node"), "node", "left_semi").join(counts, "node", "left").join(classes, "node", "left")
    nodes = nodes.select("label", "x", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "node").alias("component"))
    every = rows.join(nodes, ["label", "x"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "row").alias("component"))
    every = settle(every, "linked")
    least = every.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return every.join(least, "component").select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


@query(
    "op4_embeddings",
    """
    WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings),
    u AS (SELECT vec_id, label, x, len(x) AS d, sqrt(list_inner_product(x, x)) AS size FROM v WHERE label IS NOT NULL
      AND x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.d = b.d AND a.vec_id <> b.vec_id
      AND a.size > 0 AND b.size > 0 AND list_inner_product(a.x, b.x) / (a.size * b.size) >= 0.93),
    reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    least AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
    counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(m, e.vec_id))::BIGINT AS component_id,
      e.vec_id = least(e.vec_id, coalesce(m, e.vec_id)) AS kept
    FROM embeddings e LEFT JOIN least ON least.a = e.vec_id LEFT JOIN counts ON counts.a = e.vec_id""",
)
def op4_embeddings(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
