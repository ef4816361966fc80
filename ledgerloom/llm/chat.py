"""Chat formatting in budgeted windows: turn-aligned spans, a kept system turn, limited history, a loss mask."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import in_arrow, query, table, to_batch
from ledgerloom.session import settle

BUDGET, HISTORY = 1024, 256
BEGIN, END = "<|im_start|>", "<|im_end|>\n"

# Strings that chat templates in use give a meaning to. Inside texts they are written with a backslash
# behind the first character, and backslashes are doubled, so that a text can neither end a turn nor begin one.
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def estimated_tokens(text: Column) -> Column:
    """A token for each four bytes, and four for the marks of the turn."""
    return (F.ceil(F.octet_length(text) / 4) + 4).cast("long")


def _placed(turns: DataFrame, blocks: int) -> DataFrame:
    """Adds ``start``: the tokens of the turns before it in its conversation.

    Rows are range-partitioned on their order, so that one conversation with a third of all turns lies in many
    blocks; sums run within a block, and begin at the sum of the conversation's blocks before.
    """
    order = ["turn", "role", "tie", "row"]
    rows = settle(turns.repartitionByRange(blocks, "conv_id", *order).withColumn("block", F.spark_partition_id()), "turns")
    sums = rows.groupBy("conv_id", "block").agg(F.sum("tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), before.alias("before"))
    own = F.coalesce(F.sum("tokens").over(Window.partitionBy("conv_id", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("own", own).join(sums, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
    return placed.select("conv_id", "row", "role", "tokens", (F.col("before") + F.col("own")).alias("start"))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens=estimated_tokens, blocks: int | None = None) -> DataFrame:
    """Columns conv_id, window, text, context_turns, loss (array of start, end), n_tokens, over_budget.

    A window's text is its turns in the template: first a repeated system turn (the conversation's first turn, if
    that is its role), then up to ``history`` tokens of the turns before, then its own. The first ``context_turns``
    turns are such repeats. ``loss`` has the spans, in characters, of the texts of its own assistant turns, so every
    assistant turn is learned from once. ``window`` is the number of tokens before its first own turn.

    Prefix sums of turn tokens choose the windows. What the budget leaves beside system turn and history (a quarter
    of it at least) is the room; own turns start in the same half room and are no larger than it, so they fit.
    A larger turn is a window of its own and may exceed the budget; turns are never cut.

    Turns go by ``turn``, those with equal numbers by role and hash of the text. Null texts and roles count as
    empty; a null conv_id is a conversation like any other, a null turn comes first. Repeated rows are repeated
    turns. An empty table gives no windows; other columns are ignored.
    """
    spark = conversations.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"),
    )
    turns = settle(turns, "turns")  # numbered once: a second reading may be split otherwise
    sized = turns.withColumn("tokens", tokens(F.col("text"))).withColumn("tie", F.xxhash64("text"))
    placed = settle(_placed(sized.drop("text"), blocks), "placed")

    first = placed.where("start = 0 and role = 'system'").select(F.col("conv_id").alias("c"), F.col("row").alias("system_row"), F.col("tokens").alias("system_tokens"))
    placed = placed.join(first, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c").withColumn("system_tokens", F.coalesce("system_tokens", F.lit(0)))
    room = F.greatest(F.lit(budget) - F.lit(history) - F.col("system_tokens"), F.lit(max(2, budget // 4)))
    half = F.floor(room / 2).cast("long")
    large = F.col("tokens") > half
    # Turns of one cell lie side by side, but a large one in between parts them: the cell's second part starts anew.
    cells = placed.withColumns({"cell": F.floor(F.col("start") / half), "large": large})
    inner = Window.partitionBy("conv_id", "cell").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumn("part", F.count_if("large").over(inner))
    whole = Window.partitionBy("conv_id", "cell", "part", "large")
    own = settle(cells.withColumn("window", F.min("start").over(whole)).select("conv_id", "row", "role", "tokens", "start", "window", "system_row", "system_tokens"), "windows")

    heads = own.where("start = window").select("conv_id", "window", "system_row")
    bucket = F.floor(F.col("start") / max(1, history))
    at = F.floor(F.col("window") / max(1, history))
    wanted = heads.withColumn("bucket", F.explode(F.array(at, at - 1))).select(F.col("conv_id").alias("c"), F.col("window").alias("w"), "bucket")
    earlier = own.where("system_row is null or row != system_row").withColumn("bucket", bucket).select("conv_id", "bucket", "row", "start", "tokens")
    near = F.col("conv_id").eqNullSafe(F.col("c")) & (earlier["bucket"] == wanted["bucket"]) & (F.col("start") < F.col("w")) & (F.col("start") >= F.col("w") - history)
    repeats = earlier.join(wanted, near).select("conv_id", F.col("w").alias("window"), "row", "start")
    kept = heads.where("window > 0 and system_row is not null").select("conv_id", "window", F.col("system_row").alias("row"), F.lit(0).cast("long").alias("start"))
    parts = own.select("conv_id", "window", "row", "start").unionByName(repeats).unionByName(kept)

    texts = turns.select("row", F.col("role"), escape(F.col("text")).alias("text"), tokens(F.col("text")).alias("tokens"))
    parts = parts.join(texts, "row").withColumn("own", F.col("start") >= F.col("window"))
    grouped = parts.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(F.struct("start", "row", "role", "text", "own"))).alias("parts"), F.sum("tokens").alias("n_tokens"))
    header = lambda p: F.concat(F.lit(BEGIN), F.replace(escape(p["role"]), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
    drawn = F.transform("parts", lambda p: F.struct(header(p).alias("head"), p["text"].alias("text"), (p["own"] & (p["role"] == "assistant")).alias("learned"), p["own"].alias("own")))
    length = lambda p: F.length(p["head"]) + F.length(p["text"]) + F.lit(len(END))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state, p):
        start = state["at"] + F.length(p["head"])
        span = F.struct(start.alias("start"), (start + F.length(p["text"])).alias("end"))
        return F.struct((state["at"] + length(p)).alias("at"), F.when(p["learned"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    grouped = grouped.withColumn("drawn", drawn)
    return grouped.select(
        "conv_id", "window", F.array_join(F.transform("drawn", lambda p: F.concat(p["head"], p["text"], F.lit(END))), "").alias("text"),
        F.size(F.filter("drawn", lambda p: ~p["own"])).alias("context_turns"), F.aggregate("drawn", empty, step)["spans"].alias("loss"), "n_tokens", (F.col("n_tokens") > budget).alias("over_budget"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Columns conv_id, window, turns (array of role and text, without repeats), learned (texts under the mask), chars."""
    pieces = F.split("text", r"<\|im_end\|>\n")
    pieces = F.slice(pieces, F.col("context_turns") + 1, F.size(pieces) - 1 - F.col("context_turns"))
    # The role ends at the first line feed without a backslash before it.
    pattern = r"(?s)^<\|im_start\|>((?:[^\\\n]|\\.)*)\n(.*)$"
    turn = lambda p: F.struct(unescape(F.regexp_extract(p, pattern, 1)).alias("role"), unescape(F.regexp_extract(p, pattern, 2)).alias("text"))
    learned = F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])))
    return formatted.select("conv_id", "window", F.transform(pieces, turn).alias("turns"), learned.alias("learned"), F.length("text").cast("long").alias("chars"))


def digests(back: DataFrame) -> DataFrame:
    """The digests of each conversation. SHA-256 takes a conversation's text in order, so its windows stream through
    one task, which holds a batch and the state of two hashes, however long the conversation is."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = back.select("conv_id", "window", F.size("turns").cast("long").alias("n"), said.alias("said"), F.array_join("learned", "").alias("learned"), "chars")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        state, out = None, []

        def done():
            conv, turns, said, learned, loss, chars = state
            out.append((conv, turns, said.hexdigest(), learned, loss.hexdigest(), chars))

        for batch in batches:
            for conv, _, n, said, learned, chars in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or state[0] != conv:
                    if state is not None:
                        done()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += n
                state[2].update(said.encode())
                state[3] += len(learned)
                state[4].update(learned.encode())
                state[5] += chars
            if out:
                yield to_batch(out, names, kinds)
                out.clear()
        if state is not None:
            done()
            yield to_batch(out, names, kinds)

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return in_arrow(dealt, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


@query("op3_chat")
def op3_chat(spark, sf_dir):
    given = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return digests(read_back(windows(given.unionByName(more))))
