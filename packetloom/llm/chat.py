"""Chat formatting over reply trees.

Messages name the message they answer, so a conversation is a tree (or several). Self-joins that double their reach lead every
message to its root, in as many rounds as the logarithm of the longest path; on the way they add up scores. The leaves of each tree are
ranked by the score of their path, and the paths of the best `keep` leaves (or of all) are found by running the same jumps backwards. Each
chosen path becomes one text; messages that several paths share are in each of them.

The template of a turn is `### role: text</turn>` and a line end. In texts and roles a backslash becomes `\\\\`, `###` becomes `\\h`,
`</turn>` becomes `\\t`, and in roles a colon becomes `\\c`; so control strings cannot appear in them, and `read_back` is exact.
The loss mask is the list of places, in characters of the formatted text, of the escaped assistant texts.

A formatted conversation is one row and is put together in one task; everything before that works on single messages.

Defined cases: NULL texts and roles are empty; a NULL conversation id is a conversation of its own, and not the one with an empty id; a message
whose parent is missing is a root, so its tree has rows of its own; of messages with the same conversation and id the smallest by parent, role,
text and score counts, so repeated rows change nothing; a message without an id cannot be answered, and equal ones are one; messages
that answer each other in a circle are on no path; equal scores go to the leaf with the smaller message id, one without id last;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import staged

ASSISTANT = "assistant"
_ESCAPES = {"\\": "\\\\", "###": "\\h", "</turn>": "\\t", ":": "\\c"}
_BACK = {"\\\\": "\\", "\\h": "###", "\\t": "</turn>", "\\c": ":"}
_IN_TEXT = re.compile(r"\\|###|</turn>")
_IN_ROLE = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\[\\htc]")
_TURN = re.compile(r"### ([^:]*): (.*?)</turn>\n", re.DOTALL)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[0]], text)


def format_turns(turns: list[tuple[str, str]], learned: str = ASSISTANT) -> tuple[str, list[int], list[int]]:
    """The formatted text of (role, text) turns, and the first and past-the-last places of the texts that count for the loss."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        head = f"### {_IN_ROLE.sub(lambda m: _ESCAPES[m[0]], role)}: "
        body = _IN_TEXT.sub(lambda m: _ESCAPES[m[0]], text)
        if role == learned:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += [head, body, "</turn>\n"]
        at += len(head) + len(body) + 8
    return "".join(parts), starts, ends


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _named(col: Column | str) -> Column:
    """A key that is never NULL where `col` has a value, and never the same for NULL and a value."""
    return F.concat(F.lit("v"), (F.col(col) if isinstance(col, str) else col).cast("string"))


def chosen_paths(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """`conv_id, root_id, leaf_id, rank, depth, role, text` of the best `keep` (None: all) root-to-leaf paths of each tree of
    `messages` (conv_id, msg_id, parent_id, role, text, score); rank 1 is the best of its tree."""
    content = [
        F.col("parent_id"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    ]
    read = messages.select("conv_id", "msg_id", F.coalesce(_named("conv_id"), F.lit("n")).alias("conv"), F.struct(*content).alias("m"))
    nameless = F.concat(F.lit("n"), F.hex(F.xxhash64("m")))
    keyed = read.withColumn("msg", F.coalesce(_named("msg_id"), nameless))
    single = keyed.groupBy("conv_id", "msg_id", "conv", "msg").agg(F.min("m").alias("m"))
    rows = staged(single.select("conv_id", "msg_id", "conv", "msg", _named("m.parent_id").alias("parent"), "m.role", "m.text", "m.score"), "messages")

    ids = rows.select("conv", F.col("msg").alias("parent"), F.lit(True).alias("there"))
    up = F.when(F.col("there"), F.col("parent"))
    reach = rows.select("conv", "msg", "parent", "score").join(ids, ["conv", "parent"], "left")
    # `far` is the root, once a message's jump has passed it.
    step = reach.select("conv", "msg", up.alias("up"), F.when(up.isNull(), F.col("msg")).alias("far"), F.col("score").alias("sum"), F.lit(1).alias("depth"))
    step = staged(step, "jumps")
    longest = rows.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    jumps = [step.select("conv", "msg", "up")]
    while 2 ** (len(jumps) - 1) < longest and step.filter("up IS NOT NULL").head(1):
        over = step.select("conv", F.col("msg").alias("up"), *[F.col(c).alias(f"{c}2") for c in ("up", "far", "sum", "depth")])
        # Messages that have reached their root take no part any more.
        joined = step.filter("up IS NOT NULL").join(over, ["conv", "up"])
        onward = joined.select(
            "conv", "msg", F.col("up2").alias("up"), F.col("far2").alias("far"), (F.col("sum") + F.col("sum2")).alias("sum"),
            (F.col("depth") + F.col("depth2")).alias("depth"),
        )
        step = staged(onward.unionByName(step.filter("up IS NULL")), "jumps")
        jumps.append(step.select("conv", "msg", "up"))
    rooted = step.filter("up IS NULL").select("conv", "msg", "far", "sum", "depth")  # the others go round in circles
    answered = rows.select("conv", F.col("parent").alias("msg")).filter("msg IS NOT NULL").distinct()
    names = rows.select("conv", "msg", "msg_id")
    leaves = rooted.join(answered, ["conv", "msg"], "left_anti").join(names, ["conv", "msg"])
    place = [F.desc("sum"), F.asc_nulls_last("msg_id"), F.asc("msg")]
    if keep == 1:
        best = F.min(F.struct(-F.col("sum"), F.col("msg_id").isNull(), "msg_id", "msg"))
        chosen = leaves.groupBy("conv", "far").agg(best.alias("best")).select("conv", "far", F.col("best.msg").alias("leaf"), F.lit(1).alias("rank"))
    else:
        ranked = leaves.withColumn("rank", F.row_number().over(Window.partitionBy("conv", "far").orderBy(*place)))
        chosen = ranked.filter("true" if keep is None else F.col("rank") <= keep).select("conv", "far", F.col("msg").alias("leaf"), "rank")
    chosen = staged(chosen, "leaves")
    path = chosen.select("conv", "leaf", F.col("leaf").alias("msg"))
    # Each hop is used once, the longest first, so every ancestor is reached once and the plan grows with the number of hops only.
    for hop in reversed(jumps):
        both = F.array_compact(F.array("msg", "up"))
        path = path.join(hop, ["conv", "msg"], "left").select("conv", "leaf", F.explode(both).alias("msg"))
    marked = staged(path, "paths")
    shown = chosen.join(names.select("conv", F.col("msg").alias("far"), F.col("msg_id").alias("root_id")), ["conv", "far"])
    shown = shown.join(names.select("conv", F.col("msg").alias("leaf"), F.col("msg_id").alias("leaf_id")), ["conv", "leaf"]).drop("far")
    turns = marked.join(rows, ["conv", "msg"]).join(rooted.select("conv", "msg", "depth"), ["conv", "msg"])
    return turns.select("conv_id", "conv", "leaf", "depth", "role", "text").join(shown, ["conv", "leaf"])


def format_trees(messages: DataFrame, learned: str = ASSISTANT, keep: int | None = 1) -> DataFrame:
    """`conv_id, root_id, leaf_id, rank, formatted, loss_starts, loss_ends`, one row per chosen path."""
    names = ["conv_id", "root_id", "leaf_id", "rank"]
    turn = F.struct("depth", "role", "text")
    grouped = chosen_paths(messages, keep).groupBy(*names, "conv", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns")).drop("conv", "leaf")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [format_turns([(t["role"], t["text"]) for t in turns], learned) for turns in batch.column("turns").to_pylist()]
            text, starts, ends = zip(*made) if made else ((), (), ())
            longs = pa.list_(pa.int64())
            cols = [*(batch.column(c) for c in names), pa.array(text, pa.string()), pa.array(starts, longs), pa.array(ends, longs)]
            yield pa.RecordBatch.from_arrays(cols, [*names, "formatted", "loss_starts", "loss_ends"])

    kinds = [messages.schema[c].dataType.simpleString() for c in ("conv_id", "msg_id", "msg_id")]
    schema = "conv_id {}, root_id {}, leaf_id {}, rank int, formatted string, loss_starts array<long>, loss_ends array<long>"
    return grouped.mapInArrow(run, schema.format(*kinds))


def linear_messages(turns: DataFrame) -> DataFrame:
    """Messages of `turns` (conv_id, turn, role, text), each answering the one before it by turn, then role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = turns.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("msg_id"))
    parent = F.when(F.col("msg_id") > 1, F.col("msg_id") - 1)
    return numbered.withColumn("parent_id", parent).withColumn("score", F.lit(0.0))


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader gets back from `format_trees`, as counts and SHA-256 digests."""

    def one(text: str, starts: list[int], ends: list[int]) -> tuple[int, str, int, str, int]:
        turns = read_back(text)
        whole = "".join(f"{role}\n{body}\n" for role, body in turns)
        loss = "".join(unescape(text[i:j]) for i, j in zip(starts, ends))
        sha = lambda t: hashlib.sha256(t.encode("utf-8")).hexdigest()
        return len(turns), sha(whole), len(loss), sha(loss), len(text)

    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(*r) for r in zip(*(batch.column(c).to_pylist() for c in ("formatted", "loss_starts", "loss_ends")))]
            cols = list(zip(*rows)) if rows else [()] * 5
            arrays = [batch.column("conv_id"), *[pa.array(c, k) for c, k in zip(cols, kinds)]]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", *names])

    kind = formatted.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(run, schema)
