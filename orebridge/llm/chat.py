"""Chat formatting over reply trees.

A message names its parent. Root-to-leaf paths come from iterative self-joins that double
their reach (jump tables of 2^k hops), so a thread of n turns takes log2(n) joins; each
table is checkpointed. Branches are ranked by the sum of their messages' scores (ties:
longer first, then the smaller leaf id), and each chosen path becomes one conversation:

    ### role: text </turn>\n

Control strings inside texts are escaped reversibly: a backslash is put before every
backslash, '<' and '#', in roles before ':' too, so neither '###' nor '</turn>' can appear
in a text. The loss mask covers exactly the escaped assistant texts, as code point spans.

Defined cases: null text or role counts as empty; a parent that does not exist makes its
child a root; messages on a cycle belong to no root and are left out; equal message ids in
a conversation are numbered apart by the caller (`thread_messages` does so); a null
conversation id is one conversation; an empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window as W, functions as F

from orebridge.llm.common import ship_code
from orebridge.session import reliable_checkpoint

LOSS_ROLE = "assistant"
_TURN = re.compile(r"### ((?:[^\\<#:]|\\.)*): ((?:[^\\<#]|\\.)*) </turn>\n", re.S)


def escape(text: str, marks: str = "\\<#") -> str:
    for m in marks:                 # the backslash comes first
        text = text.replace(m, "\\" + m)
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans under the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"### {escape(role, chr(92) + '<#:')}: ", escape(text)
        if role == LOSS_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts.append(f"{head}{body} </turn>\n")
        at += len(parts[-1])
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation; an error if it is not one."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at character {at}")
    return turns


def thread_messages(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """Messages of flat conversations: each turn replies to the one before it (ties of turn
    in order of role and text)."""
    order = W.partitionBy("c").orderBy(F.col("__turn").asc_nulls_first(), "role", "text")
    m = rows.select(_conv_key(conv).alias("c"), F.col(conv).alias("conv_id"), F.col(turn).alias("__turn"),
                    F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    m = m.withColumn("id", F.row_number().over(order).cast("long"))
    return m.select("conv_id", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"),
                    "role", "text", F.lit(0.0).alias("score"))


def _conv_key(conv: str):
    return F.coalesce(F.concat(F.lit("v"), F.col(conv).cast("string")), F.lit("n"))


def tree_paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """(c, leaf, rank, id, up): for each chosen branch its messages, `up` hops above the
    leaf. messages: conv_id, id, parent, score. branches: how many per root, None = all."""
    m = messages.select(_conv_key("conv_id").alias("c"), "id", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = m.select(F.col("c").alias("pc"), F.col("id").alias("pid"))
    m = m.join(known, (F.col("c") == F.col("pc")) & (F.col("parent") == F.col("pid")), "left")
    m = reliable_checkpoint(m.select("c", "id", F.col("pid").alias("up"), F.col("score").alias("gain"),
                                     F.lit(1).cast("long").alias("hops"), F.col("id").alias("root")))
    longest = m.groupBy("c").count().agg(F.max("count")).first()[0] or 0
    jumps, cur = [], m
    for _ in range(int(longest - 1).bit_length() if longest else 0):
        jumps.append(cur.select("c", "id", "up").where("up IS NOT NULL"))
        far = cur.select(F.col("c").alias("fc"), F.col("id").alias("fid"), F.col("up").alias("fup"),
                         F.col("gain").alias("fgain"), F.col("hops").alias("fhops"), F.col("root").alias("froot"))
        # only messages that have not reached their root move on
        moved = (cur.where("up IS NOT NULL").join(far, (F.col("c") == F.col("fc")) & (F.col("up") == F.col("fid")))
                 .select("c", "id", F.col("fup").alias("up"), (F.col("gain") + F.col("fgain")).alias("gain"),
                         (F.col("hops") + F.col("fhops")).alias("hops"), F.col("froot").alias("root")))
        cur = reliable_checkpoint(cur.where("up IS NULL").unionByName(moved))
    # what still has a way up is on, or below, a cycle
    parents = m.where("up IS NOT NULL").select(F.col("c").alias("pc"), F.col("up").alias("pid")).distinct()
    leaves = cur.where("up IS NULL").join(parents, (F.col("c") == F.col("pc")) & (F.col("id") == F.col("pid")), "left_anti")
    best = W.partitionBy("c", "root").orderBy(F.desc("gain"), F.desc("hops"), "id")
    leaves = leaves.withColumn("rank", F.row_number().over(best))
    if branches is not None:
        leaves = leaves.where(F.col("rank") <= branches)
    path = leaves.select("c", F.col("id").alias("leaf"), "root", "rank", "id", F.lit(0).cast("long").alias("height"))
    for k, jump in enumerate(jumps):
        j = jump.select(F.col("c").alias("jc"), F.col("id").alias("jid"), "up")
        more = path.join(j, (F.col("c") == F.col("jc")) & (F.col("id") == F.col("jid")))
        path = reliable_checkpoint(path.unionByName(more.select(
            "c", "leaf", "root", "rank", F.col("up").alias("id"), (F.col("height") + (1 << k)).alias("height"))))
    return path


def format_conversations(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """One row per chosen branch: conv_id, root, leaf, rank, formatted, loss (spans)."""
    ship_code(messages.sparkSession)
    path = tree_paths(messages, branches)
    body = messages.select(_conv_key("conv_id").alias("bc"), "conv_id", F.col("id").alias("bid"),
                           F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = path.join(body, (F.col("c") == F.col("bc")) & (F.col("id") == F.col("bid"))) \
                .select("c", "conv_id", "root", "leaf", "rank", F.struct((-F.col("height")).alias("at"), "role", "text").alias("turn"))
    whole = turns.groupBy("c", "conv_id", "root", "leaf", "rank").agg(F.array_sort(F.collect_list("turn")).alias("turns"))

    @F.pandas_udf("formatted string, loss array<struct<start:int,stop:int>>")
    def formatted(turn_lists):
        import pandas as pd
        out = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in turn_lists]
        return pd.DataFrame({"formatted": [f for f, _ in out],
                             "loss": [[{"start": a, "stop": b} for a, b in s] for _, s in out]})

    return whole.select("conv_id", "root", "leaf", "rank", formatted("turns").alias("f")) \
                .select("conv_id", "root", "leaf", "rank", "f.formatted", "f.loss")


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say, read back from them: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars."""
    ship_code(formatted.sparkSession)

    @F.pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    def digests(texts, masks):
        import hashlib

        import pandas as pd
        rows = []
        for text, mask in zip(texts, masks):
            turns = read_turns(text)
            said = "".join(f"{role}\n{body}\n" for role, body in turns)
            loss = unescape("".join(text[s["start"]:s["stop"]] for s in mask))
            rows.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                         hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        return pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.withColumn("d", digests("formatted", "loss")).select("conv_id", "d.*")
