"""Chat logs to training text by replaying events (operator 5), DataFrame functions only.

A log row is an event of a message: ``delta`` adds text, ``edit`` and ``regenerate`` put their text
in place of all before; events are in the order of ``seq``, then kind, then text. The last event's
role is the message's. What is left is one final text a message. A conversation's messages are in the order of ``turn``,
then role, then text, and are rendered as

    <s><|start|>ROLE<|text|>TEXT<|end|>\n ... </s>

Inside roles and texts a backslash follows every backslash and every first character of a control
string (``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``), so that no text can end its turn, and
dropping one backslash before any character gives the text back. The loss mask lists where the
assistant's texts stand in the rendered text, in code points.

Null texts and roles are empty. A null conversation id is a conversation of its own. Repeated rows
of a table of whole turns are turns of their own. Events go to tasks by conversation, and a
conversation is one row in the end, so its size is what a task must hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BEGIN, START, TEXT, END, CLOSE = "<s>", "<|start|>", "<|text|>", "<|end|>\n", "</s>"
CONTROL = r"\\|<(?=\||/?s>)|\[(?=/?INST\])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def replayed(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id``, ``turn``, ``role``, ``text`` of a log (conv_id, turn, seq, kind, role, text).

    Events of a conversation and turn are of one message, unless a column ``message`` tells several of a turn apart.
    Rows without a known ``kind`` are messages of their own.
    """
    if "message" not in events.columns:
        events = events.withColumn("message", F.lit(0).cast("long"))
    events = events.withColumns({c: F.coalesce(c, F.lit("")) for c in ("kind", "role", "text")})
    parts = events.where(F.col("kind").isin("delta", "edit", "regenerate"))
    of_message = Window.partitionBy("conv_id", "turn", "message")
    # From the last event back: a running frame, which a frame up to the end is not.
    later = of_message.orderBy(F.desc("nth")).rowsBetween(Window.unboundedPreceding, -1)
    reset = F.when(F.col("kind") != "delta", True)
    folded = (
        parts.withColumn("nth", F.row_number().over(of_message.orderBy("seq", "kind", "text", "role")))
        .withColumn("replaced", F.max(reset).over(later))
        .where("replaced is null")
        .groupBy("conv_id", "turn", "message")
        .agg(
            F.max_by("role", "nth").alias("role"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "text"))), lambda x: x["text"]), "").alias("text"),
        )
    )
    whole = events.where(~F.col("kind").isin("delta", "edit", "regenerate"))
    return folded.drop("message").unionByName(whole.select("conv_id", "turn", "role", "text"))


def rendered(messages: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, and ``loss``, an array of (start, end)."""
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = (
        messages.withColumns({c: F.coalesce(c, F.lit("")) for c in ("role", "text")})
        .withColumn("nth", F.row_number().over(in_order))
        .withColumn("head", F.concat(F.lit(START), escaped(F.col("role")), F.lit(TEXT)))
        .withColumn("body", escaped(F.col("text")))
        .withColumn("piece", F.concat("head", "body", F.lit(END)))
    )
    up_to = Window.partitionBy("conv_id").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.sum(F.length("piece").cast("long")).over(up_to) + len(BEGIN) - len(END)
    placed = turns.withColumn("until", until)
    return (
        placed.groupBy("conv_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("nth", "piece"))).alias("pieces"),
            F.array_sort(
                F.collect_list(
                    F.when(F.col("role") == trained, F.struct((F.col("until") - F.length("body")).alias("start"), F.col("until").alias("end")))
                )
            ).alias("loss"),
        )
        .select(
            "conv_id",
            F.concat(F.lit(BEGIN), F.array_join(F.col("pieces.piece"), ""), F.lit(CLOSE)).alias("formatted"),
            "loss",
        )
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation."""
    inner = F.substr(formatted, F.lit(len(BEGIN) + 1), F.length(formatted) - len(BEGIN) - len(CLOSE))
    pieces = F.filter(F.split(inner, r"<\|end\|>\n"), lambda x: x != "")
    return F.transform(
        pieces,
        lambda x: F.struct(
            unescaped(F.substr(F.substring_index(x, TEXT, 1), F.lit(len(START) + 1))).alias("role"),
            unescaped(F.substring_index(x, TEXT, -1)).alias("text"),
        ),
    )


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the mask, unescaped."""
    return unescaped(
        F.array_join(F.transform(loss, lambda x: F.substr(formatted, (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))), "")
    )


def chat_digest(chats: DataFrame) -> DataFrame:
    """Counts and digests read back from rendered conversations."""
    turns = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return (
        chats.withColumn("turns", read_back(F.col("formatted")))
        .withColumn("trained", loss_text(F.col("formatted"), F.col("loss")))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
            F.length("trained").cast("long").alias("loss_chars"),
            F.sha2("trained", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )
