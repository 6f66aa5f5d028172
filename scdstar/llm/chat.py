"""Chat formatting of reply trees: root-to-leaf paths by iterative self-joins.

Messages are nodes with a parent in the same tree. Self-joins double the distance that a node
looks up each round, so a path of 1000 messages takes ten joins and not a thousand:

1. Up: every node learns its ancestor 2**k steps above, the number of steps to its root and
   the sum of scores on the way. Each round's table is written; rounds end when no
   node has an ancestor that far up.
2. Leaves, nodes that nothing replies to, are ranked for each root by the mean score of their
   path, in two steps: within salted parts of a tree, then among the best of the parts.
3. Down: the chosen leaves take in ancestors 2**k above what they have, from the largest k to
   0, which yields every message of every chosen path once.
4. Messages of a path are gathered into one string, a conversation.

The template writes a turn as ``<|turn|>role`` newline ``text<|end|>`` newline. Inside roles
and texts a backslash becomes two and ``<|`` becomes ``<\\|``, so neither mark can
occur in them, and the two replacements can be undone; in roles a newline becomes
``\\n``. The loss mask covers the texts of assistant turns, as spans of the formatted string.

Defined results: null roles and texts count as empty. A node whose parent is missing is a root;
messages on a cycle have no root and are in no path. Repeated node ids make repeated
messages of a path; equal scores are decided by the smaller leaf id. Rows
without an id of tree or node are ignored, and so are further columns. A tree without
messages has no conversation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scdstar.session import stage

TURN, END = "<|turn|>", "<|end|>\n"
#: Parts of a tree whose leaves are ranked apart before the best meet.
SALTS = 16


def escaped(value: Column) -> Column:
    return F.replace(
        F.replace(F.coalesce(value, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|")
    )


def unescaped(value: Column) -> Column:
    """Undo :func:`escaped`. Between doubled backslashes every single one is a mark's."""
    pieces = F.split(value, r"\\\\", -1)
    return F.array_join(F.transform(pieces, lambda p: F.replace(p, F.lit("\\|"), F.lit("|"))), "\\")


def _role(value: Column) -> Column:
    return F.replace(escaped(value), F.lit("\n"), F.lit("\\n"))


def _role_back(value: Column) -> Column:
    pieces = F.split(value, r"\\\\", -1)
    return F.array_join(
        F.transform(
            pieces,
            lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|")),
        ),
        "\\",
    )


def paths(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """``(tree, leaf, place, node)`` for the chosen paths of ``nodes(tree, node, parent,
    score)``: the ``branches`` best for each root, or all. ``place`` counts from the root."""
    nodes = nodes.filter("tree IS NOT NULL AND node IS NOT NULL").select(
        "tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")
    )
    there = nodes.select("tree", F.col("node").alias("parent")).distinct()
    known = nodes.join(there.withColumn("found", F.lit(True)), ["tree", "parent"], "left")
    first = stage(
        known.groupBy("tree", "node").agg(
            F.min(F.when(F.col("found"), F.col("parent"))).alias("up"), F.sum("score").alias("total")
        ).withColumn("steps", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long"))
        .withColumn("root", F.when(F.col("up").isNull(), F.col("node"))),
        "tree-up-0",
    )
    inner = first.filter("up IS NOT NULL").select("tree", F.col("up").alias("node")).distinct()
    leaves = first.join(inner, ["tree", "node"], "left_anti").select("tree", "node")
    # Nodes that have met their root are done; only the others go on to the next round.
    done, going = [first.filter("up IS NULL")], first.filter("up IS NOT NULL")
    levels, n_nodes = [going.select("tree", "node", "up")], first.count()
    while not going.isEmpty() and 1 << len(levels) <= 2 * n_nodes:
        above = reduce(DataFrame.unionByName, [*done, going]).select(
            "tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("steps2"),
            F.col("total").alias("total2"), F.col("root").alias("root2"),
        )
        step = stage(
            going.join(above, ["tree", "up"]).select(
                "tree", "node", F.col("up2").alias("up"), (F.col("total") + F.col("total2")).alias("total"),
                (F.col("steps") + F.col("steps2")).alias("steps"), F.col("root2").alias("root"),
            ),
            f"tree-up-{len(levels)}",
        )
        done.append(step.filter("up IS NULL"))
        going = step.filter("up IS NOT NULL")
        levels.append(going.select("tree", "node", "up"))
    ends = reduce(DataFrame.unionByName, done).join(leaves, ["tree", "node"]).select(
        "tree", "root", F.col("node").alias("leaf"), "steps",
        (F.col("total") / (F.col("steps") + 1)).alias("mean"),
    )
    if branches is not None:
        salt = F.pmod(F.xxhash64("leaf"), F.lit(SALTS))
        ends = ends.withColumn("salt", salt)
        for by in ("tree, root, salt", "tree, root"):
            ends = ends.withColumn("rank", F.expr(
                f"row_number() OVER (PARTITION BY {by} ORDER BY mean DESC, leaf)"
            )).filter(F.col("rank") <= branches)
    taken = ends.select("tree", "leaf", F.col("leaf").alias("node"), F.col("steps").alias("place"))
    for k in range(len(levels) - 1, -1, -1):
        taken = taken.unionByName(
            taken.join(levels[k], ["tree", "node"]).select(
                "tree", "leaf", F.col("up").alias("node"), (F.col("place") - (1 << k)).alias("place")
            )
        )
        if k:
            taken = stage(taken, f"tree-down-{k}")
    return taken


def formatted(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """``(tree, leaf, formatted, loss)``: a row for each chosen path of ``messages(tree, node,
    parent, role, text, score)``. ``loss`` are spans ``(start, length)`` in code points, from 0."""
    chosen = stage(paths(messages, branches), "tree-paths")
    said = messages.filter("tree IS NOT NULL AND node IS NOT NULL").select(
        "tree", "node", _role(F.col("role")).alias("role"), escaped(F.col("text")).alias("text")
    )
    head, around = len(TURN) + 1, len(TURN) + 1 + len(END)
    turns = chosen.join(said, ["tree", "node"]).withColumn("at", F.expr(
        # Where each turn starts: the lengths before it, in the order they are written in.
        f"sum({around} + length(role) + length(text)) OVER (PARTITION BY tree, leaf"
        " ORDER BY place, node, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        f" - {around} - length(role) - length(text)"
    )).groupBy("tree", "leaf").agg(
        F.sort_array(F.collect_list(F.struct("at", "role", "text"))).alias("turns")
    )
    return turns.select(
        "tree", "leaf",
        F.array_join(F.transform("turns", lambda t: F.concat(
            F.lit(TURN), t["role"], F.lit("\n"), t["text"], F.lit(END)
        )), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: F.struct(
            (t["at"] + head + F.length(t["role"])).alias("start"),
            F.length(t["text"]).cast("long").alias("length"),
        )).alias("loss"),
    )


def parsed(conversations: DataFrame) -> DataFrame:
    """``conversations`` with ``turns``, an array of ``(role, text)`` read back from
    ``formatted``."""
    pieces = F.split("formatted", r"<\|end\|>\n", -1)

    def turn(piece: Column) -> Column:
        line = F.instr(piece, "\n")
        return F.struct(
            _role_back(F.substring(piece, F.lit(len(TURN) + 1), line - len(TURN) - 1)).alias("role"),
            unescaped(F.substring(piece, line + 1, F.length(piece))).alias("text"),
        )

    return conversations.withColumn(
        "turns", F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)
    )


def loss_text(formatted: Column, loss: Column) -> Column:
    """The unescaped texts under the mask, one after another."""
    return F.array_join(F.transform(loss, lambda s: unescaped(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))
    )), "")


def chains(conversations: DataFrame) -> DataFrame:
    """Conversations whose rows are turns, as trees of one branch: each row replies to the one
    before it by ``turn`` (ties by role and text). Longer texts of an assistant score higher."""
    order = "PARTITION BY conv_id ORDER BY turn, role, text"
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").alias("tree"), F.expr(f"CAST(row_number() OVER ({order}) AS BIGINT)").alias("node"),
        "role", "text",
    ).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn(
        "score", F.when(F.col("role") == "assistant", F.length("text")).otherwise(0)
    )
