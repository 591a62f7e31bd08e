"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
context, and only its text lies under the loss mask. The template marks turns
with control strings; in texts and roles a backslash after each ``[``, ``<`` and
``\\`` keeps any control string from appearing, and taking it away restores them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TURN, SAYS, END, REPLY, STOP = "[INST]", "[SAYS]", "[/INST]", "[REPLY]", "</s>"
TARGET_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<\\])\\", "$1")


def opening(role: Column) -> Column:
    """What stands before a turn's escaped text."""
    return F.when(role == TARGET_ROLE, F.lit(REPLY)).otherwise(F.concat(F.lit(TURN), escape(role), F.lit(SAYS)))


def closing(role: Column) -> Column:
    return F.when(role == TARGET_ROLE, F.lit(STOP)).otherwise(F.lit(END))


def expand(turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """``conv_id, example, n_context, formatted, loss_start, loss_end, is_last``.

    ``formatted`` holds ``n_context`` turns and, under ``[loss_start, loss_end)`` in
    code points, the text of the target. Turns after the last assistant's form one
    more example without a target, so no turn is lost. ``is_last`` marks the one
    example of a conversation that holds all its turns.

    Null text and null roles count as empty; turns go by number (null first), ties
    by role and text; repeated rows are turns of their own; null ``conv_id`` is a
    conversation. An empty table gives none. Other columns are left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    shaped = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
            F.concat(opening(role), escape(text), closing(role)).alias("marked"),
            F.length(opening(role)).alias("head"), F.length(closing(role)).alias("tail"),
        ).alias("t"),
    )
    whole = shaped.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    # A conversation that does not end with a target has one example more.
    places = F.filter(
        F.sequence(F.lit(0), F.size("t") - 1),
        lambda i: (F.col("t")[i]["role"] == TARGET_ROLE) | (i == F.size("t") - 1),
    )
    each = whole.select("conv_id", "t", F.posexplode(places).alias("example", "at"))
    marked = F.array_join(F.slice(F.col("t")["marked"], 1, F.col("at") + 1), "")
    this = F.col("t")[F.col("at")]
    targeted = this["role"] == TARGET_ROLE
    each = each.select(
        "conv_id", "example", marked.alias("formatted"), this.alias("this"), targeted.alias("targeted"),
        F.when(targeted, F.col("at")).otherwise(F.col("at") + 1).alias("n_context"),
        (F.col("at") == F.size("t") - 1).alias("is_last"),
    )
    end = F.length("formatted") - F.col("this.tail")
    start = F.length("formatted") - F.length("this.marked") + F.col("this.head")
    return each.select(
        "conv_id", "example", "n_context", "formatted",
        F.when(F.col("targeted"), start).alias("loss_start"), F.when(F.col("targeted"), end).alias("loss_end"), "is_last",
    )


def under_mask(formatted: Column, start: Column, end: Column) -> Column:
    """The trainable text of an example, unescaped."""
    return unescape(F.substring(formatted, start + 1, end - start))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    # No control string occurs inside a turn, so each turn ends at its own mark.
    pieces = F.regexp_extract_all(formatted, F.lit(r"(?s)\[(?:INST|REPLY)\].*?(?:\[/INST\]|</s>)"), F.lit(0))
    return F.transform(
        pieces,
        lambda p: F.when(
            p.startswith(REPLY),
            F.struct(
                F.lit(TARGET_ROLE).alias("role"),
                unescape(F.substring(p, F.lit(len(REPLY) + 1), F.length(p) - len(REPLY) - len(STOP))).alias("text"),
            ),
        ).otherwise(
            F.struct(
                unescape(F.substring(F.substring_index(p, SAYS, 1), F.lit(len(TURN) + 1), F.length(p))).alias("role"),
                unescape(
                    F.substring(p, F.length(F.substring_index(p, SAYS, 1)) + len(SAYS) + 1,
                                F.length(p) - F.length(F.substring_index(p, SAYS, 1)) - len(SAYS) - len(END))
                ).alias("text"),
            )
        ),
    )


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted examples: turns, loss text and sizes.

    Examples of a conversation lie in one partition already, so this adds no shuffle.
    """
    loss = F.struct("example", under_mask(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("text"))
    kept = examples.select(
        "conv_id", F.length("formatted").cast("long").alias("size"),
        F.when(F.col("loss_start").isNotNull(), loss).alias("loss"),
        F.when(F.col("is_last"), F.col("formatted")).alias("last"),
    )
    grouped = kept.groupBy("conv_id").agg(
        F.sum("size").alias("formatted_chars"), F.sort_array(F.collect_list("loss")).alias("loss"),
        F.first("last", ignorenulls=True).alias("last"),
    )
    read = grouped.select("conv_id", "formatted_chars", "loss", read_turns(F.col("last")).alias("turns"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join(F.col("loss")["text"], "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"), F.sha2(trained, 256).alias("loss_sha256"),
        "formatted_chars", F.size("loss").cast("long").alias("n_examples"),
    )
