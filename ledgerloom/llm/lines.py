"""Line dedup: a prefix join on word pairs that begin with rare words; of lines within the edit bound the earliest stays."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import by_group, in_arrow, map_rows, query, table, with_row_id
from ledgerloom.session import fresh_path, remove, settle

#: Lines of this many words or more also count as repeated with one word in so many changed, put in or left out (a
#: similarity of 0.8 or more); shorter ones only if equal.
EDITABLE_WORDS = 5
#: Words are counted in so many buckets; the counts only order the keys.
BUCKETS = 1 << 20
#: Powers of two that word counts reach are told apart up to this one.
HIGHEST = 18
#: Earlier lines of a key that may be near a line by their word sets, and how many times as many it is compared with to
#: find them, in the first round; lines left open get more in the next.
CANDIDATES, COMPARED, MORE = 4, 128, 16
#: Columns of a line's word set: 256 bits, of which each word sets one. An edit changes two bits at most.
SIGNS = ["s0", "s1", "s2", "s3"]
#: Lines a task remembers, so that a line repeated within it goes out once.
REMEMBERED = 200_000
DOCS_AT_ONCE = 128
#: Keys that a task holds before it sends them, and keys of a bucket, which is what a task works on at once.
HELD_KEYS, BUCKET_KEYS = 1 << 20, 1 << 17
#: So many of the next rows of a key a row is compared with before the lengths alone decide whether it is sent on.
NEXT_ROWS = 256
#: Pairs that a task holds before it sends them, and a number that is behind all places.
HELD_PAIRS, LAST_PLACE = 1 << 18, (1 << 63) - 1
#: Bits of the filter that says which lines are worth sending on; its size does not grow with the data, and a line it
#: lets through by chance only costs its way.
FILTER_BITS = 1 << 26

#: The column that numbers rows.
ROW = "_lines_row"


def _mix(x: np.ndarray, tag: int | np.ndarray) -> np.ndarray:
    x = (x ^ (np.asarray([tag] if isinstance(tag, int) else tag, np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


#: Words hashed at once, some 50 kB of them, which a cache holds, and the base of their polynomial.
HASHED_WORDS, BASE = 1 << 13, 0x9E3779B97F4A7C15


class WordHash:
    """64 bits of words: a polynomial of their bytes, for many words at once from running sums over all their bytes."""

    def __init__(self):
        self.powers = self.inverses = np.ones(0, np.uint64)

    def __getitem__(self, word: str) -> int:
        return int(self.of([word])[0])

    def _part(self, words: list[str]) -> np.ndarray:
        text = np.frombuffer(("\n".join(words) + "\n").encode(), np.uint8)
        ends = np.flatnonzero(text == 10)
        if len(text) > len(self.powers):
            base = lambda b: np.cumprod(np.r_[np.uint64(1), np.full(2 * len(text), b, np.uint64)])
            self.powers, self.inverses = base(BASE), base(pow(BASE, -1, 1 << 64))
        sums = np.cumsum((text.astype(np.uint64) + np.uint64(1)) * self.powers[: len(text)])
        starts = np.r_[0, ends[:-1] + 1]
        sums = np.r_[np.uint64(0), sums]
        return _mix((sums[ends] - sums[starts]) * self.inverses[starts], 7)

    def of(self, words: list[str]) -> np.ndarray:
        parts = [self._part(words[i : i + HASHED_WORDS]) for i in range(0, len(words), HASHED_WORDS)]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


class Powers:
    """How common words are: the power of two that their count reaches, by bucket of the word's hash."""

    def __init__(self, counts: np.ndarray | None = None):
        counts = np.zeros(BUCKETS, np.int64) if counts is None else counts
        self.table = np.minimum(HIGHEST, np.log2(1 + counts)).astype(np.uint8)
        self.words = int(counts.sum())

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return self.table[(hashes % np.uint64(BUCKETS)).astype(np.int64)]


def most_words(n):
    """How many words a line of n words, or a longer one within its bound, can have been edited in."""
    return n // (EDITABLE_WORDS - 1)


def _edits_to_spoil(place: np.ndarray, owner: np.ndarray, lines: int) -> np.ndarray:
    """For each line how many edits it takes to spoil its chosen pairs, given in the order of the text.

    An edit spoils two pairs at most, neighbours, so a run of r chosen neighbours takes half of r, rounded up.
    """
    at = np.arange(len(place))
    begins = np.r_[True, (place[1:] != place[:-1] + 1) | (owner[1:] != owner[:-1])]
    start = np.maximum.accumulate(np.where(begins, at, 0))
    return np.bincount(owner[(at - start) % 2 == 0], minlength=lines)


def prefixes(hashes: np.ndarray, lengths: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, the number of the line of each and its place there, from the word hashes of lines of two words or more.

    A line's keys are its first pairs of neighbouring words in one order for all lines, those first that begin with a
    rare word and go on with none that is rarer, and as many as the edits that a line may have cannot all spoil. If
    lines are within the bound, some key of the line whose keys end earlier in that order is not spoilt, so the other
    line holds it as well, and among its keys, as these go further. Therefore they share a key, whatever the order, and
    its places differ by words put in or left out only. Pairs equal to the last key are keys too. Few of the first
    pairs are neighbours, which is why not many more keys are needed than edits are allowed.
    """
    owner = np.repeat(np.arange(len(lengths)), lengths)
    inside = owner[1:] == owner[:-1]
    power = powers.of(hashes)
    left, right = power[:-1][inside], power[1:][inside]
    rank = (left + np.where(right < left, HIGHEST + 1, 0)).astype(np.uint64)
    values = (rank << np.uint64(44)) | (_mix(_mix(hashes[:-1][inside], 3) + hashes[1:][inside], 1) >> np.uint64(20))
    owner = owner[1:][inside]
    starts = np.r_[0, np.cumsum(lengths - 1)[:-1]]
    # Line and value in one number are sorted several times as fast as one after the other.
    order = np.argsort((owner.astype(np.uint64) << np.uint64(50)) | values) if len(lengths) < 1 << 14 else np.lexsort((values, owner))
    turn = np.empty(len(order), np.int64)
    turn[order] = np.arange(len(order)) - starts[owner]  # owner is the same in both orders
    edits = most_words(lengths)
    low, high = edits + 1, 2 * edits + 1
    place = np.flatnonzero(turn < high[owner])  # a line takes no more
    turn, of = turn[place], owner[place]
    while (low < high).any():
        middle = (low + high) // 2
        chosen = turn < middle[of]
        enough = _edits_to_spoil(place[chosen], of[chosen], len(lengths)) > edits
        low, high = np.where(enough, low, middle + 1), np.where(enough, middle, high)
    last = values[order[starts + high - 1]]
    taken = np.flatnonzero(values <= last[owner])
    return values[taken], owner[taken], taken - starts[owner[taken]]


def key_spans(keys: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each key of a line once, with its line and its first and last place there, from what ``prefixes`` gives."""
    order = np.lexsort((keys, owner))
    keys, owner, at = keys[order], owner[order], at[order]
    begins = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])])
    return keys[begins], owner[begins], at[begins], at[np.r_[begins[1:], len(at)] - 1]


def block_keys(hashes: np.ndarray, lengths: np.ndarray, powers: Powers) -> np.ndarray:
    """The keys of ``prefixes`` as a list for each line."""
    keys, owner, _ = prefixes(hashes, lengths, powers)
    out = np.empty(len(lengths), object)
    out[:] = [keys[owner == i].tolist() for i in range(len(lengths))]
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def normal_words(line: str) -> list[str]:
    return line.lower().split()


def edit_distance(a: list[str], b: list[str]) -> int:
    """Words changed, put in or left out that turn a into b: Myers' bit vectors, in the form of Hyyroe."""
    start = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    a, b = a[start:], b[start:]
    end = next((k for k, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), min(len(a), len(b)))
    a, b = a[: len(a) - end], b[: len(b) - end]
    if not a or not b:
        return len(a) + len(b)
    places: dict[str, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    every, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = every, 0, len(a)
    for word in b:
        equal = places.get(word, 0)
        zero = (((equal & up) + up) ^ up) | equal | down
        rise, fall = down | (every & ~(zero | up)), zero & up
        distance += bool(rise & last) - bool(fall & last)
        rise, fall = (rise << 1 | 1) & every, fall << 1 & every
        up, down = fall | (every & ~(zero | rise)), rise & zero
    return distance


def within_one_edit(a: list[str], b: list[str]) -> bool:
    """Whether one edit for each ``EDITABLE_WORDS`` words of the longer line, or less, turns a into b."""
    bound = max(len(a), len(b)) // EDITABLE_WORDS
    return abs(len(a) - len(b)) <= bound and edit_distance(a, b) <= bound


def line_id(words: list[str]) -> tuple[int, int]:
    """128 bits of the normalised line, as two longs."""
    import xxhash

    h = xxhash.xxh3_128_intdigest(" ".join(words))
    return _signed(h & 0xFFFFFFFFFFFFFFFF), _signed(h >> 64)


PLACE = "struct<no_id:boolean,doc_id:bigint,row:bigint,line:bigint>"


def _place(prefix: str = ""):
    """The order that decides which of two lines is earlier: id (nulls last), row, line."""
    return F.struct(F.col(prefix + "doc_id").isNull().alias("no_id"), F.col(prefix + "doc_id").alias("doc_id"), F.col(prefix + "row").alias("row"), F.col(prefix + "line").alias("line"))


def _word_sets(hashes: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """The columns ``SIGNS`` of lines with a word, from their words' hashes, one line after the other."""
    starts = np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64)
    bits, part = np.uint64(1) << (hashes & np.uint64(63)), (hashes >> np.uint64(6)) & np.uint64(3)
    return [np.bitwise_or.reduceat(np.where(part == np.uint64(i), bits, np.uint64(0)), starts).view(np.int64) for i in range(len(SIGNS))]


def _lines(texts: DataFrame) -> DataFrame:
    """A row for each line with a word: its place, 128 bits of its normalised text, its number of words and word set.

    Each task adds a row that only holds how often its words come, packed, for ``_word_powers``.
    """

    def run(batches):
        import xxhash

        words_hash, words_in = WordHash(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(start, DOCS_AT_ONCE)
                numbers, digests, counts, lengths, every = [], [], [], [], []
                for text in part.column(2).to_pylist():
                    before = len(numbers)
                    for number, line in enumerate((text or "").split("\n")):
                        if words := normal_words(line):
                            numbers.append(number)
                            digests.append(xxhash.xxh3_128_digest(" ".join(words)))
                            lengths.append(len(words))
                            every += words
                    counts.append(len(numbers) - before)
                if not numbers:
                    continue
                at = pa.array(np.repeat(np.arange(part.num_rows), counts))
                halves = np.frombuffer(b"".join(digests), ">u8").reshape(-1, 2).astype(np.uint64).view(np.int64)
                columns = [part.column(0).take(at), part.column(1).take(at), pa.array(numbers, pa.int64()), pa.array(halves[:, 1].copy()), pa.array(halves[:, 0].copy())]
                hashes = words_hash.of(every)
                words_in += np.bincount((hashes % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
                columns += [pa.array(lengths, pa.int32()), *map(pa.array, _word_sets(hashes, np.array(lengths))), pa.nulls(len(numbers), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        at = np.flatnonzero(words_in)
        if len(at):
            packed = zlib.compress(_packed(np.diff(at, prepend=0).astype(np.uint32)) + _packed(words_in[at]), 1)
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, pa.int32() if c == "n" else pa.int64()) for c in names[:-1]), pa.array([packed])], names=names)

    names = ["doc_id", "row", "line", "h", "g", "n", *SIGNS, "words"]
    schema = "doc_id long, row long, line long, h long, g long, n int, s0 long, s1 long, s2 long, s3 long, words binary"
    return in_arrow(texts.select("doc_id", "row", "text"), run, schema)


def _word_powers(counted: DataFrame) -> Powers:
    """From the words of all texts, as ``_lines`` counts them, or from texts; a table of fixed size comes back."""

    def run(batches):
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                packed = zlib.decompress(packed)
                at = np.cumsum(_unpacked([packed[: len(packed) // 3]], np.uint32).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(_unpacked([packed[len(packed) // 3 :]], np.int64))], names=["at", "n"])

    none = F.lit(None).cast("long")
    counted = counted if "words" in counted.columns else _lines(counted.select(none.alias("doc_id"), none.alias("row"), "text"))
    found = in_arrow(counted.select("words").where("words is not null"), run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS, np.int64)
    counts[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return Powers(counts)


def _packed(values: np.ndarray) -> bytes:
    """First bytes of all values, then second bytes and so on, which compresses well where values are small or sorted."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unpacked(packed: pa.ChunkedArray | list[bytes], kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    parts = [np.frombuffer(p if isinstance(p, bytes) else p.as_py(), np.uint8).reshape(width, -1).T for p in packed]
    return np.ascontiguousarray(np.concatenate(parts)).view(kind).reshape(-1)


def _block_rows(texts: DataFrame, word_powers: Powers) -> DataFrame:
    """Columns bucket, key, h, n, at, more: the keys of the lines long enough to be edited, packed by bucket.

    Each distinct line goes out about once for each task: with each of its keys the line, its number of words, the
    key's first place and how much further its last one is, so a line that repeats a key sends it once. Buckets grow in
    number with the words of all texts, not in size.
    """
    buckets = max(1, word_powers.words // (3 * BUCKET_KEYS))

    def send(parts):
        keys, h, n, at, more = map(np.concatenate, zip(*parts))
        keys = _mix(keys, 5)
        bucket, keys = (keys >> np.uint64(32)) % np.uint64(buckets), keys.astype(np.uint32)
        order = np.lexsort((keys, bucket))
        bucket, keys, h, n, at, more = (c[order] for c in (bucket, keys, h, n, at, more))
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[starts[1:], len(bucket)]
        packed = [pa.array([_packed(c[i:j]) for i, j in zip(starts, ends)], pa.binary()) for c in (keys, h, n, at, more)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), *packed], names=["bucket", "key", "h", "n", "at", "more"])

    def run(batches):
        words_hash, seen, parts, held = WordHash(), set(), [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, DOCS_AT_ONCE):
                every, lengths, lines = [], [], []
                for text in batch.column(0).slice(start, DOCS_AT_ONCE).to_pylist():
                    for line in (text or "").split("\n"):
                        words = normal_words(line)
                        if len(words) < EDITABLE_WORDS:
                            continue
                        h = line_id(words)[0]
                        if h in seen:
                            continue
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen.add(h)
                        every += words
                        lengths.append(len(words))
                        lines.append(h)
                if lines:
                    counts = np.array(lengths)
                    keys, owner, at, to = key_spans(*prefixes(words_hash.of(every), counts, word_powers))
                    parts.append((keys, np.array(lines, np.int64)[owner], counts[owner].astype(np.uint32), at.astype(np.uint32), (to - at).astype(np.uint32)))
                    held += len(keys)
                if held >= HELD_KEYS:
                    yield send(parts)
                    parts, held = [], 0
        if parts:
            yield send(parts)

    return in_arrow(texts.select("text"), run, "bucket int, key binary, h binary, n binary, at binary, more binary")


def _suits(n, longer):
    """Whether lines of n and of ``longer`` words, which are not fewer, can lie within the bound."""
    return longer - n <= longer // EDITABLE_WORDS


def _aligns(n, at, to, m, its_at, its_to):
    """Whether lines of n and m words within the bound can have kept a pair that one has from place ``at`` to ``to``, the
    other from ``its_at`` to ``its_to``.

    Before it so many words more must have been put in or left out as the places differ, and behind it the rest; that
    is no more than the lengths differ by, unless all places differ by more.
    """
    least, most, longer = its_at - to, its_to - at, m - n
    beyond = np.maximum(0, np.maximum(least - np.maximum(longer, 0), np.minimum(longer, 0) - most))
    return np.abs(longer) + 2 * beyond <= np.maximum(n, m) // EDITABLE_WORDS


def _shared(blocks: DataFrame) -> DataFrame:
    """The rows whose key another line of a suitable length has at a suitable place. Works on one bucket at a time.

    A line has one row for a key. Of a key with many rows some may stay that only suit by length; it is a sieve.
    """

    def run(bucket: pa.Table) -> pa.Table:
        key = _unpacked(bucket.column("key"), np.uint32)
        order = np.argsort(key, kind="stable")  # keys that come once need no more
        again = key[order[1:]] == key[order[:-1]]
        some = order[np.r_[again, False] | np.r_[False, again]]
        key, h = key[some], _unpacked(bucket.column("h"), np.int64)[some]
        n, at, to = (_unpacked(bucket.column(c), np.uint32)[some].astype(np.int64) for c in ("n", "at", "more"))
        to += at
        order = np.lexsort((h, n, key))
        key, h, n, at, to = (c[order] for c in (key, h, n, at, to))
        fresh = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (h[1:] != h[:-1])][: len(key)])
        if len(fresh):
            at, to = np.minimum.reduceat(at, fresh), np.maximum.reduceat(to, fresh)
        key, h, n = (c[fresh] for c in (key, h, n))
        keep, step = np.zeros(len(key), bool), 1
        left = np.flatnonzero(key[1:] == key[:-1])
        while len(left) and step <= NEXT_ROWS:
            right = left + step
            fit = _aligns(n[left], at[left], to[left], n[right], at[right], to[right])
            keep[left[fit]] = keep[right[fit]] = True
            step += 1
            left = left[left + step < len(key)]
            right = left + step
            left = left[(key[left] == key[right]) & _suits(n[left], n[right]) & ~(keep[left] & keep[right])]
        if len(left):  # keys with more rows than that
            many = np.isin(key, key[left])
            suits = np.r_[False, many[1:] & (key[1:] == key[:-1]) & _suits(n[:-1], n[1:])]
            keep |= suits | np.r_[suits[1:], False]
        number = bucket.column("bucket")[0].as_py()
        columns = [(np.int64(number) << np.int64(32)) | key[keep].astype(np.int64), n[keep].astype(np.int32), h[keep], at[keep].astype(np.int32), to[keep].astype(np.int32)]
        return pa.Table.from_arrays([pa.array(c) for c in columns], names=["key", "n", "h", "at", "to"])

    return blocks.groupBy("bucket").applyInArrow(run, "key long, n int, h long, at int, to int")


def _candidates(rows: DataFrame, most: int) -> DataFrame:
    """Columns h, kept_h, kept, key, step, from columns key, h, n, at, to, place, after, before and ``SIGNS``.

    Each line of a key that is open (``after`` is not null) is compared with the key's earlier lines of suitable length
    that have it at a suitable place, from the earliest on or behind the first ``after`` ones, as far as their place is
    less than ``before``. Pairs that the word sets allow for have key -1, others are left out; ``kept`` is the place of
    the earlier line. After ``most`` of them, or ``COMPARED`` times as many compared, a row with the key says where to go
    on: behind the first ``step`` lines; ``kept`` is the place of the last one compared.
    """
    names = ["h", "kept_h", "kept", "key", "step"]

    def run(batches):
        for batch in by_group(batches, "key"):
            key, h, n, at, to, place, after, before, *signs = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(8 + len(SIGNS)))
            begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            start = np.repeat(begins, np.diff(np.r_[begins, len(key)]))
            other = start + np.maximum(after, 0)
            active = np.flatnonzero((after >= 0) & (other < np.arange(len(key))))
            active = active[place[other[active]] < before[active]]
            count, compared, last = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64), np.full(len(key), -1)
            found, held = [], 0
            while len(active):
                its = other[active]
                fits = _aligns(n[active], at[active], to[active], n[its], at[its], to[its])
                over = fits & ((count[active] == most) | (compared[active] == COMPARED * most))
                left, right = active[over], its[over]
                if len(left):
                    found.append((h[left], h[last[left]], place[last[left]], key[left], right - start[left]))
                left, right = active[fits & ~over], its[fits & ~over]
                compared[left] += 1
                last[left] = right
                changed = sum(np.bitwise_count((s[left] ^ s[right]).view(np.uint64)).astype(np.int64) for s in signs)
                likely = changed <= 2 * (np.maximum(n[left], n[right]) // EDITABLE_WORDS)
                left, right = left[likely], right[likely]
                count[left] += 1
                if len(left):
                    found.append((h[left], h[right], place[right], np.full(len(left), -1), np.full(len(left), -1)))
                held += len(left) + int(over.sum())
                if held >= HELD_PAIRS:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=names)
                    found, held = [], 0
                active = active[~over]
                other[active] += 1
                active = active[other[active] < active]
                active = active[place[other[active]] < before[active]]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=names)

    columns = [F.coalesce("after", F.lit(-1)).alias("after"), F.coalesce("before", F.lit(-1)).alias("before"), *SIGNS]
    dealt = rows.repartition("key").sortWithinPartitions("key", "place").select("key", "h", "n", "at", "to", "place", *columns)
    pairs = in_arrow(dealt, run, "h long, kept_h long, kept long, key long, step long")
    return pairs.groupBy("h", "kept_h", "key").agg(F.max("kept").alias("kept"), F.max("step").alias("step"))


def _texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Columns h, text of the lines in ``wanted`` (and few others), each about once for each task.

    The wanted lines go to the tasks as a bit map of ``FILTER_BITS`` bits, put together by Spark in pieces of 4 kB,
    so that no text has to be shuffled to be looked up.
    """
    bit = F.pmod("h", F.lit(FILTER_BITS)) + 1  # Spark's bit maps begin at 1
    pieces = wanted.groupBy(F.bitmap_bucket_number(bit).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    bitmap = np.zeros(FILTER_BITS // 8, np.uint8)
    for piece in pieces.collect():
        start = (piece["at"] - 1) * len(piece["bits"])
        bitmap[start : start + len(piece["bits"])] = np.frombuffer(piece["bits"], np.uint8)

    def run(batches):
        seen = set()
        for batch in batches:
            found: dict[int, str] = {}
            for text in batch.column(0):
                for line in (text.as_py() or "").split("\n"):
                    words = normal_words(line)
                    if len(words) < EDITABLE_WORDS:
                        continue
                    h = line_id(words)[0]
                    bit = h % FILTER_BITS
                    if bitmap[bit >> 3] >> (bit & 7) & 1 and h not in seen:
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen.add(h)
                        found[h] = line
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.string())], names=["h", "text"])

    return in_arrow(texts.select("text"), run, "h long, text string")


def _near_lines(shared: DataFrame, places: DataFrame, texts: DataFrame) -> DataFrame:
    """Columns h, kept: for each line with an earlier one within the bound the place of the earliest.

    Every key's lines stand by place, and a line is compared with the earliest ones of each of its keys first. It
    is settled if the earliest match is not behind the end of a list that was cut short, or if no list was. In the next
    round it goes on with the lists that were cut short, and behind their ends.

    Word sets sieve the pairs where they meet; then only texts of lines left in a pair are read again and sent. What a
    round has written goes when it is done.
    """
    spark, written = texts.sparkSession, []

    def for_now(df: DataFrame, label: str) -> DataFrame:
        written.append(fresh_path(spark, label))
        return settle(df, label, written[-1])

    def verify(h, kept, a, b):
        if within_one_edit(normal_words(a), normal_words(b)):
            yield h, kept

    found, most, still = None, CANDIDATES, shared.join(places, "h").withColumns({"after": F.lit(0), "before": F.lit(LAST_PLACE)})
    while True:
        pairs = for_now(_candidates(still, most), "likely")
        likely, cut = pairs.where("key < 0"), pairs.where("key >= 0").select("h", "key", F.col("kept").alias("end"), "step")
        met = for_now(likely.select("h").unionByName(likely.select(F.col("kept_h").alias("h"))).distinct(), "met")
        own = for_now(_texts_of(texts, met).dropDuplicates(["h"]).join(met, "h", "left_semi"), "met-texts")
        both = likely.join(own.withColumnRenamed("text", "a"), "h").join(own.select(F.col("h").alias("kept_h"), F.col("text").alias("b")), "kept_h")
        near = map_rows(both.select("h", "kept", "a", "b"), verify, "h long, kept long")
        near = (near if found is None else near.unionByName(found)).groupBy("h").agg(F.min("kept").alias("kept"))
        found = settle(near, "near-lines")
        left_open = cut.join(found, "h", "left").where("kept is null or kept > end")
        left_open = left_open.select("key", "h", F.col("step").alias("after"), F.coalesce("kept", F.lit(LAST_PLACE)).alias("before"))
        left_open = settle(left_open, "open-lines")
        while written:
            remove(spark, written.pop())
        if left_open.isEmpty():
            return found
        most *= MORE
        rows = shared.join(left_open.select("key").distinct(), "key", "left_semi").join(places, "h")
        still = rows.join(left_open, ["key", "h"], "left")


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """Columns doc_id, row, line, kept_doc_id, kept_row, kept_line, edits: a row for each line that is to go.

    Lines end at a line feed and are numbered from 0; they are compared as lower-cased words. A line goes if any
    earlier line (by id, nulls last, then row and line) equals it, or if both have ``EDITABLE_WORDS`` words or more
    and one edit (a word changed, put in or left out) for each ``EDITABLE_WORDS`` words of the longer one, or fewer,
    turn it into the other. ``kept_`` names the earliest line it repeats, ``edits`` is 0 for an equal line and 1 for
    any other. That line may itself go for a yet earlier one. Lines without a word stay. Null and empty texts have
    no lines that could go. Repeated rows repeat their lines. An empty table gives no rows; other columns are ignored.

    Equal lines are settled first, by partial aggregation. For the others, each line goes out under its word pairs that
    begin with the rarest words, so many that two lines within the bound always share one, at places that suit. Lines
    that do so are candidates, earliest first and a few for each line at a time; word sets sieve them and the edit distance is
    verified on the words. Texts of such lines are fetched by another reading.
    """
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), row.alias("row"), F.col(text_col).cast("string").alias("text"))
    counted = settle(_lines(texts), "lines")
    lines = counted.where("words is null").drop("words")
    signs = [F.max(c).alias(c) for c in ("n", *SIGNS)]  # the same for equal lines
    first = settle(lines.groupBy("h", "g").agg(F.min(_place()).alias("first"), *signs), "first-lines")

    spark, written = docs.sparkSession, [fresh_path(docs.sparkSession, label) for label in ("shared", "places")]
    shared = settle(_shared(_block_rows(texts, _word_powers(counted))), "shared", written[0])
    # Should two lines agree in h, the earlier one stands for both. A number in the order of places stands for each.
    places = first.join(shared.select("h").distinct(), "h", "left_semi").groupBy("h").agg(F.min(F.struct("first", *SIGNS)).alias("it")).select("h", "it.*")
    places = settle(places.orderBy("first").withColumn("place", F.monotonically_increasing_id()), "places", written[1])
    rivals = _near_lines(shared, places.drop("first"), texts)
    rivals = settle(rivals.join(places.select(F.col("place").alias("kept"), "first"), "kept").select("h", F.col("first").alias("kept")), "rivals")
    for path in written:
        remove(spark, path)
    known = first.join(rivals, "h", "left").select("h", "g", "first", "kept")
    earliest = F.least("first", "kept")  # least() passes over nulls
    gone = lines.join(known, ["h", "g"]).withColumn("place", _place())
    gone = gone.withColumn("kept_place", F.when(F.col("kept").isNotNull(), earliest).otherwise(F.col("first"))).where(F.col("kept_place") < F.col("place"))
    edits = F.when(F.col("kept_place") == F.col("first"), F.lit(0)).otherwise(F.lit(1)).alias("edits")
    return gone.select("doc_id", "row", "line", F.col("kept_place.doc_id").alias("kept_doc_id"), F.col("kept_place.row").alias("kept_row"), F.col("kept_place.line").alias("kept_line"), edits)


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns and rows, with the lines taken out of the texts that repeat an earlier one.

    Rows are numbered and written once, as a second reading may be split otherwise. A frame that was written with a
    column ``ROW`` is taken as it is, and the column left out.
    """
    numbered = docs if ROW in docs.columns else settle(with_row_id(docs, ROW), "numbered")
    gone = repeated_lines(numbered, id_col, text_col, ROW).groupBy(F.col("row").alias(ROW)).agg(F.collect_list("line").alias("_lines_gone"))
    rows = numbered.join(gone, ROW, "left")
    parts = F.split(F.col(text_col), "\n", -1)
    left = F.array_except(F.sequence(F.lit(0).cast("long"), F.size(parts).cast("long") - 1), "_lines_gone")
    kept = F.array_join(F.transform(left, lambda i: F.get(parts, i.cast("int"))), "\n")
    text = F.when(F.col("_lines_gone").isNull(), F.col(text_col)).otherwise(kept)
    return rows.withColumn(text_col, text).select(*[F.col(f"`{c}`") for c in docs.columns if c != ROW])


@query("op9_line_dedup")
def op9_line_dedup(spark, sf_dir):
    return repeated_lines(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "line", "kept_doc_id", "kept_line", "edits")
