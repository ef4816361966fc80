"""Personal data: fixed kinds by pattern, and bootstrapped contextual extraction of further identifiers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_rows, query, table, with_row_id
from ledgerloom.session import settle

KINDS = ("email", "ip", "card", "phone")

# The patterns of the four kinds. The look-behind of IP only skips starts inside a run of digits that
# has failed from its first digit; it keeps long runs of digits linear.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: A word that may be an identifier: it has a digit or an at sign, or an at sign spelt out. Looked for at word starts only.
CANDIDATE = re.compile(r"(?<!\S)(?:[^\s0-9@]*[0-9@]\S*|[^\s(\[]+(?:\[at\]|\(at\))\S+)")
EDGES = " \t\r\n.,;:!?\"'()[]{}<>"
CONTEXT_CHARS = 64

#: A pattern is believed if so many different known identifiers stand in its context ...
LEAST_SEEDS = 5
#: ... and this share of all that stands there is known or believed, counted with doubt of one.
LEAST_CONFIDENCE = 0.8
ROUNDS = 3


def emails(text: str):
    """Leftmost non-overlapping addresses, from each at sign outwards, so that no run of letters is read twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the four kinds, in order. Matches that fail a check are dropped."""
    out = [(s, 0, e) for s, e in emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in m.group().split("."))]
    for m in CARD.finditer(text):
        if 12 <= len(d := digits_of(m.group())) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return sorted(out)


def _contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a span: two words on the left, one on either side, one on the left with a mark."""
    before = text[max(0, start - CONTEXT_CHARS) : start].lower().split()[-2:]
    after = text[end : end + CONTEXT_CHARS].lower().split()[:1]
    out = []
    if before:
        if len(before) == 2:
            out.append(f"{before[0]} {before[1]} _")
        if after:
            out.append(f"{before[-1]} _ {after[0]}")
        if before[-1][-1] in ":=#":
            out.append(f"{before[-1]} _")
    return out


def occurrences(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """What may be an identifier, with its contexts: the base spans (kind 0 to 3) and other such words (kind -1)."""
    out, taken, i = [], [(s, e) for s, _, e in base], 0
    for s, kind, e in base:
        out.append({"kind": kind, "start": s, "end": e, "value": text[s:e].lower(), "contexts": _contexts(text, s, e)})
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        while s < e and text[s] in EDGES:
            s += 1
        while e > s and text[e - 1] in EDGES:
            e -= 1
        while i < len(taken) and taken[i][1] <= s:
            i += 1
        if s < e and (i == len(taken) or taken[i][0] >= e):
            out.append({"kind": -1, "start": s, "end": e, "value": text[s:e].lower(), "contexts": _contexts(text, s, e)})
    return out


OCCURRENCE = "array<struct<kind:int,start:int,end:int,value:string,contexts:array<string>>>"
SPAN = "array<struct<start:int,kind:int,end:int>>"


def read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns row, doc_id, base (spans), seen (occurrences with contexts)."""

    def run(row, doc_id, text):
        base = base_spans(text or "")
        spans = [{"start": s, "kind": k, "end": e} for s, k, e in base]
        yield row, doc_id, spans, occurrences(text or "", base)

    rows = with_row_id(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), "row")
    return map_rows(rows.select("row", "doc_id", "text"), run, f"row long, doc_id long, base {SPAN}, seen {OCCURRENCE}")


def believed_patterns(seen: DataFrame) -> DataFrame:
    """Columns pattern, kind, confidence, from columns kind, value, pattern of all occurrences.

    The graph has patterns and values as nodes and an edge where a value stands in a pattern's context. Known
    identifiers start with belief 1 in their kind. A round believes in a pattern as far as the values in its
    context are believed, and in a value as far as its best pattern is. Edges are counted once per pair, so neither
    copies nor a hot context weigh more than they say, and sums are pre-aggregated.
    """
    edges = settle(seen.groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "pattern-graph")
    known = edges.where("kind >= 0").select("value", "kind").distinct().withColumn("belief", F.lit(1.0))
    size = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    belief, patterns = known, None
    for _ in range(ROUNDS):
        support = edges.select("pattern", "value").join(belief, "value").groupBy("pattern", "kind").agg(F.sum("belief").alias("b"), F.count_if(F.col("belief") == 1.0).alias("seeds"))
        patterns = support.join(size, "pattern").select("pattern", "kind", (F.col("b") / (F.col("n") + 1)).alias("confidence"), "seeds")
        patterns = settle(patterns.where((F.col("seeds") >= LEAST_SEEDS) & (F.col("confidence") >= LEAST_CONFIDENCE)), "patterns")
        found = edges.where("kind < 0").select("pattern", "value").join(patterns, "pattern").groupBy("value", "kind").agg(F.max("confidence").alias("belief"))
        belief = known.unionByName(found.select("value", "kind", "belief")).groupBy("value", "kind").agg(F.max("belief").alias("belief"))
    return patterns.select("pattern", "kind", "confidence")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns row, doc_id, base, added (arrays of start, kind, end), for every row.

    ``base``: e-mail, IP, card and phone, as the patterns of this module say. ``added``: words with a digit or an at
    sign that no base span touches and that stand in a context believed to announce a kind: contexts are induced
    from the base spans of all texts, scored on the graph of contexts and values over ``ROUNDS`` rounds, and believed
    if ``LEAST_SEEDS`` known identifiers stand there and ``LEAST_CONFIDENCE`` of all values do. If contexts speak
    for several kinds the most confident wins, then the first. Null texts count as empty. Null ids and repeated rows
    keep their rows; an empty table gives none; other columns are ignored. Only words around candidates are shuffled.
    """
    rows = settle(read(docs, id_col, text_col), "pii")
    seen = rows.select("row", F.explode("seen").alias("s")).select("row", "s.*").select("row", "kind", "start", "end", "value", F.explode("contexts").alias("pattern"))
    patterns = believed_patterns(seen.select("kind", "value", "pattern"))
    news = seen.where("kind < 0").drop("kind", "value").join(patterns, "pattern")
    news = news.groupBy("row", "start", "end").agg(F.min(F.struct(-F.col("confidence"), F.col("kind").alias("kind"))).alias("best"))
    news = news.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", F.col("best.kind").alias("kind"), "end"))).alias("added"))
    return rows.select("row", "doc_id", "base").join(news, "row", "left").withColumn("added", F.coalesce("added", F.array().cast(SPAN)))


def shown(spans):
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: int):
    return lambda span: span["kind"] == kind


@query("op1_pii")
def op1_pii(spark, sf_dir):
    found = personal_data(table(spark, sf_dir, "documents", "doc_id", "text"))
    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    every = F.array_sort(F.concat("base", "added"))
    return found.select("doc_id", *counts, F.sha2(shown(F.col("base")), 256).alias("base_sha256"), shown(every).alias("spans"))
