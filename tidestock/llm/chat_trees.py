"""Chat formatting from reply trees.

Messages name their parent. Iterated self-joins double the reach of every message's pointer, so
after k joins it points 2^k replies up: depth, score sum and root of all messages cost as many
joins as the depth has binary digits. Leaves rank the branches of their tree by the summed scores;
each chosen leaf's path is then expanded with the stored pointers, longest reach first, which yields
every message of the path once. Ids and scores alone go through these joins; texts are joined at
the end, and each path is formatted as one conversation:

    <|im_start|>role\\ntext<|im_end|>\\n   for every turn

Control strings inside texts are escaped: every ``<``, backslashes and ``|`` in a row get one
backslash more, so no text can contain ``<|``, and taking one away restores it. In roles, line ends
and backslashes are escaped as well. The loss mask is the list of code point spans of the
assistant's (escaped) texts.

Defined results: null text and role are empty; a missing parent makes a message a root; a reply
cycle is an error; equal scores rank by message id; a null tree id is a tree of its own, whose
conversations have a null tree; a message without an id is an error; rows that repeat a message are
one message, two different messages with one id in a tree an error; an empty table gives no
conversations.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidestock.llm.rows import map_rows
from tidestock.session import staged

NO_TREE = -(1 << 63)
START, END, LEARNED = "<|im_start|>", "<|im_end|>", "assistant"
CONTROL, ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
FORMATTED = "tree long, leaf long, score double, formatted string, loss array<struct<start: long, stop: long>>"


def escape(text: str) -> str:
    return CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and its loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == LEARNED:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in TURN.finditer(formatted)]


def read_loss(formatted: str, spans: list[tuple[int, int]]) -> str:
    """All text under the mask, unescaped."""
    return "".join(unescape(formatted[a:b]) for a, b in spans)


def reach(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``tree, node, root, depth, total`` of all messages, and the pointers of each reach 1, 2, 4, ..."""
    known = messages.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    up = F.when(F.col("known"), F.col("parent"))
    state = staged(messages.select("tree", "node", "parent", "score").join(known, ["tree", "parent"], "left").select(
        "tree", "node", up.alias("up"), F.coalesce(up, "node").alias("root"),
        F.when(up.isNotNull(), 1).otherwise(0).cast("long").alias("depth"), F.coalesce("score", F.lit(0.0)).alias("total"),
    ), "replies")
    limit = state.count()
    pointers = []
    while not (going := state.where("up is not null")).isEmpty():
        if 1 << len(pointers) > limit:
            raise ValueError("replies form a cycle")
        pointers.append(going.select("tree", "node", "up"))
        above = state.select(
            "tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("root").alias("top"),
            F.col("depth").alias("higher"), F.col("total").alias("more"),
        )
        moved = going.join(above, ["tree", "up"]).select(
            "tree", "node", F.col("next").alias("up"), F.col("top").alias("root"),
            (F.col("depth") + F.col("higher")).alias("depth"), (F.col("total") + F.col("more")).alias("total"),
        )
        state = staged(state.where("up is null").union(moved), "replies")
    return state.drop("up"), pointers


def best_paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """``tree, leaf, score, node, position`` (0 at the root) of the chosen root-to-leaf paths.

    ``branches`` paths of each tree by falling score; None for all.
    """
    state, pointers = reach(messages)
    parents = messages.select("tree", F.col("parent").alias("node"))
    leaves = state.join(parents, ["tree", "node"], "left_anti")
    if branches is not None:
        rank = Window.partitionBy("tree").orderBy(F.desc("total"), "node")
        leaves = leaves.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= branches)
    path = leaves.select("tree", F.col("node").alias("leaf"), F.col("total").alias("score"), "node", F.col("depth").alias("position"))
    for k in reversed(range(len(pointers))):
        here = F.struct("node", "position")
        up = F.when(F.col("up").isNotNull(), F.struct(F.col("up").alias("node"), (F.col("position") - (1 << k)).alias("position")))
        path = path.join(pointers[k], ["tree", "node"], "left").select(
            "tree", "leaf", "score", F.explode(F.array_compact(F.array(here, up))).alias("at")
        ).select("tree", "leaf", "score", "at.*")
    return path


def unique_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages without their texts, each once, and their roles and texts; null trees get a number."""
    tree = F.coalesce(F.col("tree").cast("long"), F.lit(NO_TREE)).alias("tree")
    role, text = (F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text"))
    version = F.xxhash64(role, text).alias("version")
    slim = staged(messages.select(tree, "node", "parent", "score", version).distinct(), "messages")
    doubtful = slim.groupBy("tree", "node").count().where("count > 1 or node is null")
    if not doubtful.isEmpty():
        raise ValueError(f"message ids must be unique in their tree and not null: {doubtful.first()}")
    return slim.drop("version"), messages.select(tree, "node", role, text).dropDuplicates(["tree", "node"])


def format_trees(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """Formats the chosen paths of ``messages`` (``tree, node, parent, role, text, score``; ids are numbers).

    Returns ``tree, leaf, score, formatted, loss``.
    """
    slim, texts = unique_messages(messages)
    turns = best_paths(slim, branches).join(texts, ["tree", "node"])
    whole = turns.groupBy("tree", "leaf", "score").agg(
        F.sort_array(F.collect_list(F.struct("position", "role", "text"))).alias("turns")
    )

    def work(rows):
        for tree, leaf, score, turns in rows:
            formatted, spans = format_turns([(t["role"], t["text"]) for t in turns])
            yield None if tree == NO_TREE else tree, leaf, score, formatted, [{"start": a, "stop": b} for a, b in spans]

    return map_rows(whole, work, FORMATTED)


def conversations_as_trees(conversations: DataFrame) -> DataFrame:
    """Messages of linear conversations ``conv_id, turn, role, text``: each turn answers the one before.

    A null conversation id becomes the least number; equal turns are ordered by role and text.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    numbered = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_TREE)).alias("tree"), "turn", "role", "text"
    ).withColumn("node", F.row_number().over(order).cast("long"))
    return numbered.select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(1.0).alias("score")
    )
