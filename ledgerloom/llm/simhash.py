"""SimHash near-duplicates with bit-sliced comparison of fingerprints."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import by_group, components, group_roots, in_arrow, query, table, tiled, with_row_id
from ledgerloom.session import settle

RADIUS = 3
#: Two of five blocks are equal in any two fingerprints that differ in three bits or fewer.
BLOCKS, KEPT = (13, 13, 13, 13, 12), 2
TILE_ROWS = 2048
#: Rows of small groups that are compared together, as one batch of bit planes costs the same for few rows as for many.
PACK_ROWS = 512
SHINGLES_AT_ONCE = 1 << 16


def fingerprint_of(text: bytes) -> int:
    """64-bit SimHash of the 3-word shingles, repeats included; 0 without a word."""
    from functools import partial

    import xxhash

    words = text.lower().split()  # of bytes: A-Z only, and white space is \x20 and \x09-\x0D
    if not words:
        return 0
    grams = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) > 2 else iter([b" ".join(words)])
    hashes = map(partial(xxhash.xxh64_intdigest, seed=42), grams)
    total, ones = 0, np.zeros(64, np.int64)
    while len(h := np.fromiter(itertools.islice(hashes, SHINGLES_AT_ONCE), np.uint64)):
        total += len(h)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return sum(1 << int(i) for i in np.flatnonzero(2 * ones > total))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """Columns doc_id, row (the row's number, or ``row_col``), fp (the fingerprint as a signed long). Null text counts as empty."""

    def run(batches):
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            fps = pa.array([_signed(fingerprint_of(t.as_py() or b"")) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps], names=["doc_id", "row", "fp"])

    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), row.alias("row"), F.col(text_col).cast("string").alias("text"))
    return in_arrow(rows.select("doc_id", "row", "text"), run, "doc_id long, row long, fp long")


def _words(bits: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.packbits(bits, axis=1, bitorder="little")).view(np.uint64)


def _past(over, ones, twos, radius: int):
    """Where the count of differing bits exceeds the radius."""
    return over | (np.zeros_like(over), ones & twos, twos, ones | twos)[3 - radius]


def near_pairs(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs, both ways round, of 64-bit values that differ in at most ``radius`` (3 or fewer) bits.

    The values stand as bit planes. For all rows at once, each plane adds its differing bits to counters that are
    bit-sliced too (ones, twos, and whether four was reached): a few word operations update 64 distances. Rows whose
    distances all exceed the radius are dropped as the planes go by, and the block is left when none remains.
    """
    n = len(fps)
    words = (n + 63) // 64
    bits = np.unpackbits(fps.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    planes = _words(np.pad(bits.T, ((0, 0), (0, words * 64 - n))))
    flip = np.where(bits.T, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
    out_left, out_right = [], []
    step = max(1, (1 << 17) // words)
    for start in range(0, n, step):
        rows = np.arange(start, min(n, start + step))
        own = np.zeros((len(rows), words * 64), np.uint8)
        own[:, n:] = 1
        own[np.arange(len(rows)), rows] = 1
        over = _words(own)  # padding and the row itself are out
        ones, twos = np.zeros_like(over), np.zeros_like(over)
        for plane in range(64):
            differs = planes[plane][None, :] ^ flip[plane][rows][:, None]
            carry = ones & differs
            ones ^= differs
            more = twos & carry
            twos ^= carry
            over |= more
            if plane % 8 == 7:
                past = _past(over, ones, twos, radius)
                alive = (past != np.uint64(0xFFFFFFFFFFFFFFFF)).any(axis=1)
                if not alive.any():
                    rows = rows[:0]
                    break
                if alive.sum() < 0.7 * len(rows):
                    rows, over, ones, twos = rows[alive], over[alive], ones[alive], twos[alive]
        if len(rows):
            i, j = np.nonzero(np.unpackbits((~_past(over, ones, twos, radius)).view(np.uint8), axis=1, bitorder="little"))
            out_left.append(rows[i])
            out_right.append(j)
    if not out_left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_left), np.concatenate(out_right)


def _packs(gids: np.ndarray) -> list[slice]:
    """Runs of whole groups: small ones together up to PACK_ROWS, a larger one alone."""
    ends = np.r_[np.flatnonzero(gids[1:] != gids[:-1]) + 1, len(gids)]
    out, start, at = [], 0, 0
    for end in ends.tolist():
        if end - start > PACK_ROWS and at > start:
            out.append(slice(start, at))
            start = at
        at = end
    out.append(slice(start, len(gids)))
    return out


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``a``, ``b`` that join all distinct ``fp`` within ``radius`` bits, directly or by way of each other.

    Each fingerprint goes out under the ten pairs of its five blocks; values that share a key meet in a tile and are
    compared there. A tile gives a row for each member at most, not for each pair. Any two values of a pack that are
    close are a true link, whichever groups they came from.
    """
    shifts = np.cumsum([0, *BLOCKS[:-1]]).tolist()
    keys = []
    for t, chosen in enumerate(itertools.combinations(range(len(BLOCKS)), KEPT)):
        key = F.lit(t).cast("long")
        for b in chosen:
            part = F.shiftrightunsigned("fp", shifts[b]).bitwiseAND(F.lit((1 << BLOCKS[b]) - 1).cast("long"))
            key = F.shiftleft(key, BLOCKS[b]).bitwiseOR(part)
        keys.append(key)
    spread = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    dealt = tiled(spread, "key", F.col("fp"), TILE_ROWS).select("gid", "fp")

    def run(batches):
        for batch in by_group(batches):
            gids = batch.column(0).to_numpy()
            same = gids[1:] == gids[:-1]
            several = np.r_[False, same] | np.r_[same, False]
            gids, values = gids[several], batch.column(1).to_numpy()[several]
            for pack in _packs(gids) if len(gids) else []:
                own = np.unique(values[pack])
                roots = group_roots(len(own), *near_pairs(own.view(np.uint64), radius))
                moved = np.flatnonzero(roots != np.arange(len(own)))
                if len(moved):
                    yield pa.RecordBatch.from_arrays([pa.array(own[moved]), pa.array(own[roots[moved]])], names=["a", "b"])

    return in_arrow(dealt.repartition("gid").sortWithinPartitions("gid"), run, "a long, b long")


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """Columns doc_id, row, fp, component (a fingerprint that names the group), for every row.

    Groups are the components of fingerprints that differ in three bits or fewer. Null and empty texts have
    fingerprint 0 and link like any other. Equal fingerprints meet once, so a third of all rows being copies costs
    a partial aggregation. Null ids keep their row. An empty table gives no rows; other columns are ignored.
    """
    rows = settle(fingerprints(docs, id_col, text_col, row_col), "fingerprints")
    distinct = rows.select("fp").distinct()
    found = components(links(distinct))
    known = settle(distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("component")), "classes")
    return rows.join(known, "fp").select("doc_id", "row", "fp", "component")


def with_component_id(rows: DataFrame) -> DataFrame:
    """Adds component_id, the smallest doc_id of the component (null if it has none)."""
    least = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "component")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with one row for each group: that of the smallest id (nulls last), then the first."""
    numbered = settle(with_row_id(docs, "_simhash_row"), "numbered")  # once: a second reading may be split otherwise
    rows = simhash(numbered, id_col, text_col, "_simhash_row")
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")).alias("f"))
    kept = first.select(F.col("f.row").alias("_simhash_row"))
    return numbered.join(kept, "_simhash_row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


@query("op8_simhash")
def op8_simhash(spark, sf_dir):
    rows = with_component_id(simhash(table(spark, sf_dir, "documents", "doc_id", "text")))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
