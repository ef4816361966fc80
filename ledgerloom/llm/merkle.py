"""Merkle manifest of a dataset: a SHA-256 tree whose parents keep the hash state before each child slot."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import query, table
from ledgerloom.session import settle

FANOUT = 16
#: Levels that one group of rows raises at once, and so at most how many nodes a group has.
HEIGHT = 2
GROUP = FANOUT**HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: binary, right: binary>>"
CHANGED_EVERY = 5


def encoded(value: Column) -> Column:
    """A value as its length in UTF-8 bytes, a colon and itself; null as ``-``. No two rows give the same text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """The digest of a row as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[encoded(v) for v in values]), 256))


def levels_of(size: int) -> int:
    """Levels above ``size`` nodes until one remains."""
    levels = 0
    while size > 1:
        size, levels = -(-size // FANOUT), levels + 1
    return levels


class Subtree:
    """Consecutive nodes of a tree, raised by some levels. Digests stand as hex text.

    ``states[l][i]`` is a copy of the parent's hash state before node i of level l, so that folding a replacement
    for it hashes the replacement and its right siblings only.
    """

    def __init__(self, digests: list[bytes], levels: int):
        self.levels = [[d.hex().encode() for d in digests]]
        self.states: list[list] = []
        for _ in range(levels):
            nodes, states = [], []
            for start in range(0, len(self.levels[-1]), FANOUT):
                state = hashlib.sha256()
                for child in self.levels[-1][start : start + FANOUT]:
                    states.append(state.copy())
                    state.update(child)
                nodes.append(state.hexdigest().encode())
            self.states.append(states)
            self.levels.append(nodes)

    @property
    def top(self) -> bytes:
        return self.levels[-1][0]

    def siblings(self, i: int) -> list[tuple[bytes, bytes]]:
        """For each level: the siblings to the left and to the right of the node over node i, each joined."""
        out = []
        for nodes in self.levels[:-1]:
            start = i - i % FANOUT
            out.append((b"".join(nodes[start:i]), b"".join(nodes[i + 1 : start + FANOUT])))
            i //= FANOUT
        return out

    def folded(self, i: int, replacement: bytes, siblings: list[tuple[bytes, bytes]]) -> bytes:
        """The top if node i were ``replacement``."""
        for states, (_, right) in zip(self.states, siblings):
            state = states[i].copy()
            state.update(replacement)
            state.update(right)
            replacement, i = state.hexdigest().encode(), i // FANOUT
        return replacement


def placed(rows: DataFrame, tree: str, order: list[str], label: str) -> DataFrame:
    """Adds ``at`` (gapless from 0 within the tree, by ``order``) and ``size`` (nodes of the tree).

    Rows are range-partitioned, counted by tree and range, and numbered within ranges from the sum of the ranges
    before: a tree with a third of all rows is spread like any other. A row number splits rows that are equal.
    """
    blocks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*order, "_row"]
    rows = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(blocks, tree, *order)
    rows = settle(rows.withColumn("_block", F.spark_partition_id()), label)
    counts = rows.groupBy(tree, "_block").agg(F.count(F.lit(1)).alias("_n"))  # at most trees + ranges rows
    before = F.sum("_n").over(Window.partitionBy(tree).orderBy("_block")) - F.col("_n")
    counts = counts.select(tree, "_block", before.alias("_before"), F.sum("_n").over(Window.partitionBy(tree)).alias("size"))
    within = F.row_number().over(Window.partitionBy(tree, "_block").orderBy(*order))
    numbered = rows.withColumn("_at", within).join(counts, [tree, "_block"])
    return numbered.withColumn("at", F.col("_before") + F.col("_at") - 1).drop("_row", "_block", "_before", "_at")


def _grouped(nodes: DataFrame):
    return nodes.withColumn("group", F.floor(F.col("at") / GROUP).cast("long")).groupBy("tree", "group")


def _subtree(nodes: pa.Table) -> tuple[Subtree, list[int]]:
    """The subtree over a group's nodes, and their places within the group."""
    order = sorted(range(nodes.num_rows), key=nodes["at"].to_pylist().__getitem__)
    digests = nodes["digest"].to_pylist()
    return Subtree([digests[i] for i in order], min(HEIGHT, levels_of(nodes["size"][0].as_py()))), order


def raised(nodes: DataFrame, label: str) -> list[DataFrame]:
    """The nodes (tree, at, size, digest) and all layers above them, ``HEIGHT`` levels apart, up to one node per tree."""
    layers = [nodes]

    def up(group: pa.Table) -> pa.Table:
        subtree, _ = _subtree(group)
        at, size = group["at"][0].as_py() // GROUP, -(-group["size"][0].as_py() // GROUP)
        return pa.table({"tree": group["tree"][:1], "at": [at], "size": [size], "digest": pa.array([bytes.fromhex(subtree.top.decode())], pa.binary())})

    while (layers[-1].agg(F.max("size")).first()[0] or 0) > 1:
        groups = _grouped(layers[-1].select("tree", "at", "size", "digest"))
        layers.append(settle(groups.applyInArrow(up, "tree string, at long, size long, digest binary"), label))
    return layers


def descended(layers: list[DataFrame], paths: DataFrame, label: str) -> DataFrame:
    """Columns tree, at, path, top of the lowest layer's groups, from those of the trees' single top nodes.

    A path holds the joined siblings of each level from a node up to the root, and is that of all nodes of a group:
    a two hundred and fifty-sixth as many paths as nodes.
    """

    def down(nodes: pa.Table, above: pa.Table) -> pa.Table:
        subtree, order = _subtree(nodes)
        rest, top = above["path"][0].as_py(), above["top"][0].as_py()
        paths = [[{"left": a, "right": b} for a, b in subtree.siblings(i)] + rest for i in range(len(order))]
        ats = [nodes["at"][i].as_py() for i in order]
        return pa.table({"tree": pa.array([nodes["tree"][0].as_py()] * len(order), pa.string()), "at": ats, "path": pa.array(paths, PATHS), "top": pa.array([top] * len(order), pa.binary())})

    for layer in reversed(layers[1:]):
        nodes = layer.select("tree", "at", "size", "digest")
        paths = settle(_grouped(nodes).cogroup(_whole(paths)).applyInArrow(down, f"tree string, at long, path {PATH}, top binary"), label)
    return paths


PATHS = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))


def _whole(paths: DataFrame):
    """The path of node k of a layer belongs to group k of the layer below."""
    return paths.withColumnRenamed("at", "group").groupBy("tree", "group")


def manifest(rows: DataFrame, label: str = "manifest") -> DataFrame:
    """Columns doc_id, source, at, leaf, subroot, root, proof_sha256, folded_root, verified of every row; digests as hex.

    ``rows`` has doc_id, source, leaf (32 bytes) and replacement (32 bytes, or null: the leaf itself). Leaves of a
    source ascend by id, null ids first, rows of one id by leaf; equal rows take neighbouring places in any order.
    Sixteen consecutive nodes become their parent until one remains, the subroot; subroots, null source first, give
    the root likewise. A lone leaf is its own root. The fold resumes the state kept before the leaf's slot with the
    replacement and the right siblings only, level by level; one state for each level above a group serves all its
    leaves. The proof digest is that of all siblings on the way. An empty table gives no rows.
    """
    tree = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), F.col("source")))
    rows = rows.withColumn("tree", tree).withColumnRenamed("leaf", "digest")
    leaves = settle(placed(settle(rows, f"{label}-leaves"), "tree", ["doc_id", "digest"], f"{label}-ranges"), f"{label}-placed")
    layers = raised(leaves, f"{label}-layer")
    subroots = layers[-1].select(F.col("tree").alias("name"), F.lit("").alias("tree"), "digest")
    sources = settle(placed(subroots, "tree", ["name"], f"{label}-ranges"), f"{label}-sources")
    upper = raised(sources, f"{label}-layer")
    start = upper[-1].select("tree", "at", F.array().cast(PATH).alias("path"), F.col("digest").alias("top"))

    def to_sources(nodes: pa.Table, above: pa.Table) -> pa.Table:
        subtree, order = _subtree(nodes)
        rest, top = above["path"][0].as_py(), above["top"][0].as_py()
        paths = [[{"left": a, "right": b} for a, b in subtree.siblings(i)] + rest for i in range(len(order))]
        names, subs = (pa.array([nodes[c][i].as_py() for i in order], t) for c, t in (("name", pa.string()), ("digest", pa.binary())))
        return pa.table({"tree": names, "at": [0] * len(order), "path": pa.array(paths, PATHS), "top": pa.array([top] * len(order), pa.binary()), "subroot": subs})

    named = _grouped(sources).cogroup(_whole(descended(upper, start, f"{label}-paths")))
    tops = settle(named.applyInArrow(to_sources, f"tree string, at long, path {PATH}, top binary, subroot binary"), f"{label}-tops")
    paths = descended(layers, tops.drop("subroot"), f"{label}-paths")

    def finish(nodes: pa.Table, above: pa.Table) -> pa.Table:
        subtree, order = _subtree(nodes)
        root = above["top"][0].as_py().hex().encode()
        rest = [(x["left"], x["right"]) for x in above["path"][0].as_py()]
        kept = [hashlib.sha256(left) for left, _ in rest]
        replacements = nodes["replacement"].to_pylist()
        proofs, folds = [], []
        for i, row in enumerate(order):
            near = subtree.siblings(i)
            proof = hashlib.sha256()
            for left, right in (*near, *rest):
                proof.update(left)
                proof.update(right)
            proofs.append(proof.hexdigest())
            value = subtree.folded(i, subtree.levels[0][i] if replacements[row] is None else replacements[row].hex().encode(), near)
            for state, (_, right) in zip(kept, rest):
                state = state.copy()
                state.update(value)
                state.update(right)
                value = state.hexdigest().encode()
            folds.append(value.decode())
        taken = nodes.take(order)
        return pa.table({
            "doc_id": taken["doc_id"], "source": taken["source"], "tree": taken["tree"], "at": taken["at"], "leaf": [x.decode() for x in subtree.levels[0]],
            "root": [root.decode()] * len(order), "proof_sha256": proofs, "folded_root": folds, "verified": [x == root.decode() for x in folds],
        })

    schema = "doc_id long, source string, tree string, at long, leaf string, root string, proof_sha256 string, folded_root string, verified boolean"
    done = _grouped(leaves).cogroup(_whole(paths)).applyInArrow(finish, schema)
    subs = tops.select("tree", F.lower(F.hex("subroot")).alias("subroot"))
    return done.join(subs, "tree").select("doc_id", "source", "at", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def tampered(docs: DataFrame) -> DataFrame:
    """Rows for ``manifest`` in which every fifth document, by the checksum of its id, has a lower-cased text (A-Z)."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % CHANGED_EVERY == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = leaf(*[lowered if c == "text" else F.col(c) for c in FIELDS])
    return docs.select("doc_id", "source", leaf(*[F.col(c) for c in FIELDS]).alias("leaf"), F.when(chosen, changed).alias("replacement"))


@query("op12_merkle")
def op12_merkle(spark, sf_dir):
    rows = manifest(tampered(table(spark, sf_dir, "documents", *FIELDS)))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
