"""Byte-level BPE: encoding by overlapping chunks, and decoding."""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import PerTask, map_rows, query, table, with_row_id
from ledgerloom.session import settle

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 11
#: Distinct pre-tokens whose ids a task keeps: so many, and as many of those before that were not used since.
KEPT_PIECES = 100_000
#: Bytes up to which looking at all pairs again after each merge takes less than a heap of them.
SCANNED_BYTES = 32


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 and rank per line (its size is that of the vocabulary)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank merges first, leftmost on ties.

    Pairs wait in a heap and parts in a linked list, so a piece of n bytes takes n log n steps.
    """
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) <= SCANNED_BYTES:
        return merge_short(piece, ranks)
    import heapq

    n = len(piece)
    end = list(range(1, n + 1))  # of the part that starts here
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(ranks[pair], i, i + 2) for i in range(n - 1) if (pair := piece[i : i + 2]) in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue
        alive[end[i]] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As ``merge``, over a list of parts and the ranks of their pairs."""
    none = len(ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs and (least := min(pairs)) < none:
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


class PieceEncoder(dict):
    """Pre-token to its ids as little-endian unsigned 32-bit integers.

    When the store is full it becomes the older one, and what is still asked for comes back from there: frequent
    pieces stay, whatever passes by.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.older = ranks, {}

    def __missing__(self, piece: str) -> bytes:
        if (ids := self.older.get(piece)) is None:
            ids = struct.pack(f"<{len(found)}I", *found) if len(found := merge(piece.encode("utf-8"), self.ranks)) < 64 else np.array(found, "<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= KEPT_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


def boundaries(pattern, text: str, at: int) -> list[int]:
    """Ends of the pre-tokens of ``text``, which begins at position ``at`` of its document."""
    return [m.end() + at for m in pattern.finditer(text)]


def decode_ids(ids: bytes, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _zones(pattern_text: str) -> PerTask:
    """Boundaries that a chunk sees in its first and its last ``OVERLAP_CHARS`` characters."""

    def per_task():
        import regex

        pattern = regex.compile(pattern_text)

        def zones(row, k, last, piece, chunk, overlap):
            at = k * chunk
            ends = boundaries(pattern, piece, at)
            # The two last ends could differ if the text went on. A piece must not end in white space, as there
            # "\s+(?!\S)" looks one character ahead.
            sure = ends if last else ends[:-2]
            tail = [e for e in sure if e > at + chunk and not piece[e - at - 1].isspace()]
            yield row, k, [e for e in ends if e <= at + overlap], tail

        return zones

    return PerTask(per_task)


def _encoder(pattern_text: str, ranks: dict[bytes, int], digests: bool = False) -> PerTask:
    """Ids in place of the last column, the text; on request with their digests, in the same pass."""
    tokens = tokens_of(ranks) if digests else []

    def per_task():
        import regex

        find, encode = regex.compile(pattern_text).findall, PieceEncoder(ranks)

        def run(*row):
            ids = b"".join(map(encode.__getitem__, find(row[-1])))
            yield (*row[:-1], ids, *(digests_of(ids, tokens) if digests else ()))

        return run

    return PerTask(per_task)


def _kinds(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep: tuple[str, ...] = (), text_col: str = "text", chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, digests: bool = False) -> DataFrame:
    """Columns row (the row's number), those in ``keep``, and ids (binary, little-endian unsigned 32-bit integers), for every row;
    with ``digests`` also the columns of ``with_digests``, which short texts get in the same pass.

    A text longer than ``chunk`` characters is cut into chunks that overlap by ``overlap``. Tasks pre-tokenise the
    chunks in parallel, each from its own start, which may lie inside a pre-token. Two neighbours resynchronise at
    the first boundary that both see in the overlap: from there on they go on alike, as the pattern looks ahead but
    never back. The text between such points is then pre-tokenised and encoded, again in parallel. Where two
    chunks share no boundary (a pre-token longer than the overlap lies across), all from there on is encoded as one
    piece, so the ids are those of the whole text in every case. Shorter texts are one piece and are not moved.
    Null texts count as empty and give no ids. Rows may repeat; other columns are ignored.
    """
    rows = with_row_id(docs.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")), "row").select("row", *keep, F.col("_text").alias("text"))
    kept = rows.select("row", *keep)
    short = map_rows(rows.where(F.length("text") <= chunk), _encoder(pattern, ranks, digests), f"{_kinds(kept)}, ids binary{', ' + DIGESTS if digests else ''}")
    long = rows.where(F.length("text") > chunk)
    count = F.ceil(F.length("text") / F.lit(chunk)).cast("int")
    cut = long.select("row", *keep, F.col("text").alias("_text"), count.alias("_n"), F.explode(F.sequence(F.lit(0), count - 1)).alias("_k"))
    piece = F.substring(F.col("_text"), F.col("_k") * chunk + 1, F.lit(chunk + overlap))
    # What goes with a row is written with its first chunk: row numbers are taken once and hold from here on.
    with_row = F.when(F.col("_k") == 0, F.struct("row", *keep)).alias("kept")
    chunks = settle(cut.select("row", F.col("_k").alias("k"), (F.col("_k") == F.col("_n") - 1).alias("last"), piece.alias("piece"), with_row).repartition("row", "k"), "chunks")
    zones = map_rows(chunks.select("row", "k", "last", "piece", F.lit(chunk), F.lit(overlap)), _zones(pattern), "row long, k int, head array<long>, tail array<long>")
    w = Window.partitionBy("row").orderBy("k")
    common = F.array_min(F.array_intersect("head", F.lag("tail").over(w)))
    starts = zones.select("row", "k", F.when(F.col("k") == 0, F.lit(0)).otherwise(common).alias("start"))
    # A chunk without a common boundary, and what follows it, belongs to the piece of the last chunk that has one.
    starts = starts.withColumn("start", F.when(F.bool_or(F.col("start").isNull()).over(w), None).otherwise(F.col("start")))
    starts = starts.withColumn("head_k", F.max(F.when(F.col("start").isNotNull(), F.col("k"))).over(w))
    heads = starts.where("start is not null").select("row", "k", "start", F.lead("start").over(w).alias("stop"))
    part = chunks.join(starts.select("row", "k", "head_k"), ["row", "k"]).select("row", "k", "head_k", F.expr(f"substring(piece, 1, {chunk})").alias("own"))
    tail = chunks.select("row", F.col("k"), F.expr(f"substring(piece, {chunk} + 1)").alias("beyond"))
    part = part.join(tail, ["row", "k"])
    joined = part.groupBy("row", "head_k").agg(F.array_sort(F.collect_list(F.struct("k", "own", "beyond"))).alias("parts"))
    text = F.concat(F.array_join(F.transform("parts", lambda p: p["own"]), ""), F.element_at("parts", -1)["beyond"])
    joined = joined.select("row", F.col("head_k").alias("k"), text.alias("piece")).join(heads, ["row", "k"])
    begin = F.col("start") - F.col("k") * chunk
    length = F.coalesce(F.col("stop") - F.col("start"), F.length("piece").cast("long")).cast("int")
    pieces = joined.select("row", "k", F.substring(F.col("piece"), (begin + 1).cast("int"), length).alias("piece"))
    encoded = map_rows(pieces, _encoder(pattern, ranks), "row long, k int, ids binary")
    whole = encoded.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts"))
    whole = whole.select("row", F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
    long = chunks.where("k = 0").select("kept.*").join(whole, "row").select("row", *keep, "ids")
    return short.unionByName(with_digests(long, ranks) if digests else long)


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Columns row and data: the bytes of the ids put together, valid UTF-8 or not."""
    tokens = tokens_of(ranks)

    def run(row, ids):
        yield row, decode_ids(ids, tokens)

    return map_rows(encoded.select("row", "ids"), run, "row long, data binary")


def tokens_of(ranks: dict[bytes, int]) -> list[bytes]:
    return [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests_of(ids: bytes, tokens: list[bytes]) -> tuple[int, str, str]:
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decode_ids(ids, tokens)).hexdigest()


def with_digests(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256, of the ids and of the bytes decoded from them; ids last of the given."""
    tokens = tokens_of(ranks)

    def run(*row):
        yield (*row, *digests_of(row[-1], tokens))

    return map_rows(encoded, run, f"{_kinds(encoded)}, {DIGESTS}")


def public_bpe() -> tuple[dict[bytes, int], str]:
    """Ranks and pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


@query("op2_bpe")
def op2_bpe(spark, sf_dir):
    ranks, pattern = public_bpe()
    encoded = encode(table(spark, sf_dir, "documents", "doc_id", "text"), ranks, pattern, keep=("doc_id",), digests=True)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
