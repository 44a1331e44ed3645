"""Chat formatting with prefix-target expansion: every assistant turn becomes an example of its own.

Template: ``<s>role\\ntext</s>`` per turn. Control strings inside texts are escaped reversibly: each backslash is doubled, then a
single backslash goes behind the first character of a control string, which no doubled one can look like.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", "</s>"
# Strings with a meaning to chat templates.
CONTROL = (OPEN, CLOSE, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescape(text: Column) -> Column:
    for c in reversed(CONTROL):
        text = F.replace(text, F.lit(f"{c[0]}\\{c[1:]}"), F.lit(c))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def format_examples(conversations: DataFrame) -> DataFrame:
    """One example per assistant turn: all turns before it as context, and only its text trainable.

    ``conversations``: conv_id, turn, role, text by turn. Returns conv_id, example (from 1), target_turn, text, loss_start and
    loss_length: the trainable stretch in code points of ``text`` (from 0). Turns after the last assistant turn follow in a last
    example with nothing trainable (target_turn null), so that a conversation's last example holds all of it.

    Null texts and roles count as empty; equal turns are ordered by role and text, repeated rows stay; a null turn comes first;
    rows with null conv_id are one conversation. Further columns are ignored; an empty table gives no row.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    marked = rows.select("conv_id", F.struct("turn", "role", "text", escape(F.col("text")).alias("body")).alias("t"))
    whole = marked.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    part = lambda t: F.concat(F.lit(OPEN), F.url_encode(t["role"]), F.lit("\n"), t["body"], F.lit(CLOSE))
    n = F.size("turns")
    ends = F.filter(F.sequence(F.lit(1), n), lambda k: (F.col("turns")[k - 1]["role"] == TRAINED_ROLE) | (k == n))
    cut = whole.select("conv_id", "turns", F.transform("turns", part).alias("parts"), F.posexplode(ends).alias("example", "k"))
    last = F.col("turns")[F.col("k") - 1]
    trained = last["role"] == TRAINED_ROLE
    text = F.array_join(F.slice("parts", F.lit(1), F.col("k")), "")
    out = cut.select("conv_id", (F.col("example") + 1).cast("long").alias("example"), F.when(trained, last["turn"]).alias("target_turn"),
                     text.alias("text"), F.when(trained, F.length(last["body"])).otherwise(0).cast("long").alias("loss_length"))
    start = F.length("text") - len(CLOSE) - F.col("loss_length")
    return out.select("conv_id", "example", "target_turn", "text", start.cast("long").alias("loss_start"), "loss_length")


def read_back(examples: DataFrame) -> DataFrame:
    """Turns and trained texts as the examples hold them: conv_id, turns (role, text), losses, formatted_chars."""
    trained = unescape(F.substring(F.col("text"), (F.col("loss_start") + 1).cast("int"), F.col("loss_length").cast("int")))
    whole = examples.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("whole"), F.sum(F.length("text")).alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("example", trained.alias("text")))).alias("losses"))
    pieces = F.split("whole", CLOSE, -1)
    parts = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    turn = lambda p: F.struct(
        F.url_decode(F.substring_index(F.substring(p, len(OPEN) + 1, 2**31 - 1), "\n", 1)).alias("role"),
        unescape(F.substring(p, F.instr(p, "\n") + 1, F.lit(2**31 - 1))).alias("text"))
    return whole.select("conv_id", F.transform(parts, turn).alias("turns"), F.col("losses.text").alias("losses"), "formatted_chars")


def digest(examples: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of formatted examples."""
    back = read_back(examples)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("losses", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
