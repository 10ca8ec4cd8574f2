"""Conversations without quotations, in reply order.

1. Each message is parsed line by line: leading ``>`` marks give a line's quote
   level, and the lines that announce a quote ("... wrote:") go with it. Lines
   of level 0 are the message's own text. Quoted lines of one level in a row are
   a passage; passages and own texts are cut into sentences, normalised (lower
   case, letters and digits only) and hashed, so other line breaks don't matter.
2. A sentence quoted at level d is linked to the latest earlier message of the
   conversation that has it one level up: in its own text for d = 1, else as a
   quotation of level d - 1. Of the shallowest level with a link, the message
   covered most (the later one of equals) is the one replied to. Where no
   message has a deeper quotation one level up, the message whose own text it
   is is looked up, and its latest reply so far is the one replied to (itself,
   if it has none). A message that quotes nothing known replies to the one
   before it.
3. Conversations come in reply order: each message is followed by its replies,
   earlier ones first. Where all reply to the one before, that is the order of
   turns. Elsewhere places come from ranking the Euler tour of the reply tree
   by pointer doubling, so no task holds a conversation.

Defined cases: a null text is empty; messages of equal turn are ordered by role
and text, null turns come first; a row without a conversation is one of its
own; repeated rows are kept; an empty table gives an empty result. Columns
other than conversation, turn, role and text are not read, so names can't clash.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.llm.common import map_rows, stash
from demandspark.operators.ordered import global_rank, running_totals

MARKS = re.compile(r"((?:[ \t]{0,3}>)+)[ \t]?")
ANNOUNCED = re.compile(r"^(?:on\b.*\bwrote|am\b.*\bschrieb\b.*|le\b.*\ba écrit|el\b.*\bescribió|.{1,80}\bwrote)\s*:\s*$", re.I)
SENTENCE = re.compile(r"[.!?\n]+")
PLAIN = re.compile(r"[\W_]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """(hash, length) of the normalised sentences."""
    plain = (PLAIN.sub(" ", s).strip().lower() for s in SENTENCE.split(text))
    return [(xxhash.xxh3_64_intdigest(s) - (1 << 63), len(s)) for s in plain if s]


def split_quotes(text: str) -> tuple[str, list[tuple[int, str]]]:
    """The own text, and the quoted passages with their levels."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    level = 0
    for line in text.split("\n"):
        found = MARKS.match(line)
        if not found:
            own.append(line)
            level = 0
            continue
        depth = found[1].count(">")
        if not level:
            while own and (not own[-1].strip() or ANNOUNCED.match(own[-1].strip())):
                own.pop()
        if depth != level:
            passages.append((depth, []))
            level = depth
        passages[-1][1].append(line[found.end():])
    return ("\n".join(own).strip("\n") if passages else text), [(d, " ".join(lines)) for d, lines in passages]


def parsed_messages(rows: DataFrame) -> DataFrame:
    """uid, own (text), said (hashes of own sentences), quoted (level, hash, length), passages (how many)."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, said, quoted, passages = [], [], [], []
        for text in batch.column(1).to_pylist():
            clean, found = split_quotes(text or "")
            own.append(clean)
            said.append(sorted({h for h, _ in sentences(clean)}))
            quoted.append([{"level": d, "hash": h, "length": n} for d, passage in found for h, n in sentences(passage)])
            passages.append(len(found))
        kinds = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64()), ("length", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.string()), pa.array(said, pa.list_(pa.int64())), pa.array(quoted, kinds), pa.array(passages, pa.int32())], names=["uid", "own", "said", "quoted", "passages"])

    return map_rows(rows, "uid long, own string, said array<long>, quoted array<struct<level: int, hash: long, length: long>>, passages int", one)


def replied_to(messages: DataFrame) -> DataFrame:
    """conv, seq, to: the message that each message's quotations tell it replies to."""
    quoting = messages.where("passages > 0").select("conv").distinct()
    some = stash(messages.join(quoting, "conv", "left_semi").select("conv", "seq", "said", "quoted"), "chat-quoting")
    quoted = some.select("conv", "seq", F.explode("quoted").alias("q")).select("conv", "seq", "q.*")

    def entries(df: DataFrame, at: Column, has: int, deep: bool = False) -> DataFrame:
        asked = (F.col("level"), F.col("length")) if not has else (F.lit(0), F.lit(0).cast("long"))
        return df.select("conv", "hash", at.cast("int").alias("at"), "seq", F.lit(has).alias("has"), asked[0].alias("level"), asked[1].alias("length"), F.lit(deep).alias("deep"))

    # who has a sentence as its own (0) or as a quotation of a level, and who asks for it one level up or, deep, for its author
    said = entries(some.select("conv", "seq", F.explode("said").alias("hash")), F.lit(0), 1)
    every = said.union(entries(quoted, F.col("level"), 1)).union(entries(quoted, F.col("level") - 1, 0)).union(entries(quoted.where("level > 1"), F.lit(0), 0, True))
    earlier = Window.partitionBy("conv", "hash", "at").orderBy("seq", "has").rowsBetween(Window.unboundedPreceding, -1)
    source = F.last(F.when(F.col("has") == 1, F.col("seq")), ignorenulls=True).over(earlier)
    found = every.withColumn("to", source).where("has = 0 and to < seq").groupBy("conv", "seq", "deep", "level", "to").agg(F.sum("length").alias("covered"))
    best = F.min(F.struct("level", (-F.col("covered")).alias("covered"), (-F.col("to")).alias("to")))
    found = stash(found.groupBy("conv", "seq", "deep").agg(best.alias("best")).select("conv", "seq", "deep", (-F.col("best.to")).alias("to")), "chat-found")
    exact = found.where("not deep").select("conv", "seq", "to")
    # the author is known, but nobody between quotes it: its latest reply so far
    lost = found.where("deep").join(exact, ["conv", "seq"], "left_anti").select("conv", "seq", "to")
    replies = some.join(lost.select("conv").distinct(), "conv", "left_semi").select("conv", "seq").join(exact, ["conv", "seq"], "left").join(lost.select("conv", "seq"), ["conv", "seq"], "left_anti")
    replies = replies.select("conv", "seq", F.coalesce("to", F.col("seq") - 1).alias("to"), F.lit(1).alias("has"))
    latest = F.last(F.when(F.col("has") == 1, F.col("seq")), ignorenulls=True).over(Window.partitionBy("conv", "to").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    placed = replies.union(lost.withColumn("has", F.lit(0))).withColumn("reply", latest).where("has = 0").select("conv", "seq", F.coalesce("reply", "to").alias("to"))
    return exact.union(placed)


def reply_places(tree: DataFrame) -> DataFrame:
    """``tree`` (conv, seq, to; 0 for the first) -> conv, seq, place, depth, by ranking each tree's Euler tour."""
    siblings = running_totals(tree.withColumn("one", F.lit(1)), ["conv", "to"], ["seq"], ["one"], next_of="seq").select("conv", "seq", "to", F.col("next_seq").alias("sibling"))
    first = tree.groupBy("conv", F.col("to").alias("seq")).agg(F.min("seq").alias("child"))
    nodes = siblings.join(first, ["conv", "seq"], "left")
    down = F.struct((2 * F.col("seq")).alias("arc"), F.coalesce(2 * F.col("child"), 2 * F.col("seq") + 1).alias("next"), F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("d"))
    rise = F.coalesce(2 * F.col("sibling"), F.when(F.col("to") > 0, 2 * F.col("to") + 1))
    up = F.struct((2 * F.col("seq") + 1).alias("arc"), rise.alias("next"), F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("d"))
    arcs = stash(nodes.select("conv", F.explode(F.array(down, up)).alias("a")).select("conv", "a.*"), "tour")
    while arcs.where("next is not null").head(1):
        ahead = arcs.select("conv", F.col("arc").alias("next"), F.col("next").alias("then"), F.col("n").alias("n2"), F.col("d").alias("d2"))
        arcs = arcs.join(ahead, ["conv", "next"], "left").select("conv", "arc", F.col("then").alias("next"), (F.col("n") + F.coalesce("n2", F.lit(0))).alias("n"), (F.col("d") + F.coalesce("d2", F.lit(0))).alias("d"))
        arcs = stash(arcs, "tour")
    size = tree.groupBy("conv").agg(F.count("*").alias("size"))
    # messages and steps down from here to the tour's end
    return arcs.where("arc % 2 = 0").join(size, "conv").select("conv", (F.col("arc") / 2).cast("long").alias("seq"), (F.col("size") - F.col("n") + 1).alias("place"), (-F.col("d")).alias("depth"))


def linked_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_col``, place, depth, ``turn_col``, reply_to (a turn), ``role_col``, ``text_col`` (without quotes), n_quotes and
    formatted (the message in chat markup) of every message."""
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    rows = stash(rows.withColumn("uid", F.monotonically_increasing_id()).withColumn("sign", F.xxhash64("role", "text")), "chat-rows")
    alone = rows.where("conv is null").select("uid", F.lit(1).cast("long").alias("seq"))
    ranked = global_rank(rows.where("conv is not null").select("conv", "turn", "sign", "uid"), ["conv"], ["turn", "sign", "uid"], out="seq")
    ranked = ranked.select("uid", F.col("seq").cast("long").alias("seq")).unionByName(alone)
    messages = stash(rows.drop("text", "sign").join(parsed_messages(rows.select("uid", "text")), "uid").join(ranked, "uid"), "chat-messages")

    links = stash(replied_to(messages.where("conv is not null")), "chat-links")
    forked = links.where("to < seq - 1").select("conv").distinct()
    tree = messages.join(links, ["conv", "seq"], "left").withColumn("to", F.coalesce("to", F.col("seq") - 1))
    tree = stash(tree.drop("said", "quoted"), "chat-tree")
    places = reply_places(tree.select("conv", "seq", "to").join(forked, "conv", "left_semi"))
    placed = tree.join(places, ["conv", "seq"], "left").withColumn("place", F.coalesce("place", "seq")).withColumn("depth", F.coalesce("depth", F.col("seq") - 1))
    parents = tree.where("conv is not null").select("conv", F.col("seq").alias("to"), F.col("turn").alias("reply_to"))
    chat = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("own"), F.lit("\n<|end|>"))
    return placed.join(parents, ["conv", "to"], "left").select(
        F.col("conv").alias(conv_col), "place", "depth", F.col("turn").alias(turn_col), "reply_to", F.col("role").alias(role_col), F.col("own").alias(text_col),
        F.col("passages").alias("n_quotes"), chat.alias("formatted"),
    )
