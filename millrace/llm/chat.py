"""Chat formatting in budgeted windows.

A conversation is written as a row of windows. Prefix sums of the turns' tokens choose the turns of each window; every
window repeats the system turn and a limited stretch of history; only assistant turns that a window holds for the first
time are under its loss mask, so each is learnt once. All of it is DataFrame expressions: one shuffle by conversation
carries the turns, one by window puts them together, and the largest thing held is a window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.text import plain_words
from millrace.session import written

# The marks of the template. A turn is OPEN role NEWLINE text CLOSE; the escapes below keep both marks out
# of roles and texts.
OPEN, CLOSE = "### ", "</turn>\n"


@dataclass(frozen=True)
class Budget:
    """Tokens of a window, and of the history it may repeat. A token is a word between blanks, and a turn has
    ``per_turn`` more for its marks. The new turns of a window start within half of what the system turn and the history
    leave, so a window keeps to ``tokens`` unless one turn alone is longer than that half; turns are never cut."""

    tokens: int = 2048
    history: int = 256
    per_turn: int = 4


# What stands for a backslash and for the first characters of the marks, and, in roles, for a line break.
_ESCAPES = (("<", "{"), ("#", "%"))
_ROLE_ESCAPES = (*_ESCAPES, ("\n", "l"))


def escape(text: Column, pairs: tuple[tuple[str, str], ...] = _ESCAPES) -> Column:
    """A backslash is doubled; the others become a backslash and a letter, so no mark is left in the text."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, code in pairs:
        out = F.replace(out, F.lit(plain), F.lit(f"\\{code}"))
    return out


def unescape(text: Column, pairs: tuple[tuple[str, str], ...] = _ESCAPES) -> Column:
    out = text
    for plain, code in pairs:  # a code counts after an odd number of backslashes
        out = F.regexp_replace(out, rf"(?<!\\)((?:\\\\)*)\\[{code}]", f"$1{plain}")
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def _placed(turns: DataFrame, budget: Budget) -> DataFrame:
    """Turns with ``place`` in the conversation, ``span`` (the window that holds them first), ``next_span`` and whether
    they are ``history`` of it."""
    order = [F.col("turn").asc_nulls_first(), "role", "text", "tie"]
    conv = Window.partitionBy("conv").orderBy(*order)
    so_far = conv.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = turns.withColumns(
        {
            "place": F.row_number().over(conv),
            "tokens": F.size(plain_words(F.col("text"))) + budget.per_turn,
        }
    )
    rows = rows.withColumn("system", (F.col("place") == 1) & (F.col("role") == "system"))
    own = F.when(F.col("system"), 0).otherwise(F.col("tokens"))
    rows = rows.withColumns(
        {
            "before": F.sum(own).over(so_far) - own,
            "fixed": F.max(F.when(F.col("system"), F.col("tokens")).otherwise(0)).over(so_far),
        }
    )
    room = F.greatest(F.lit(1), F.floor((budget.tokens - budget.history - F.col("fixed")) / 2))
    rows = rows.withColumn("slot", F.floor(F.col("before") / room))
    # Spans are numbered without gaps: a long turn may pass over slots.
    opens = F.col("slot") > F.lag("slot").over(conv)
    rows = rows.withColumn("span", F.sum(F.coalesce(opens.cast("int"), F.lit(0))).over(so_far))
    ahead = Window.partitionBy("conv").orderBy("span").rangeBetween(1, 1)
    return rows.withColumn("next_start", F.min("before").over(ahead)).withColumn(
        "history", F.coalesce(F.col("before") >= F.col("next_start") - budget.history, F.lit(False)) & ~F.col("system")
    )


def format_chat(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    budget: Budget = Budget(),
) -> DataFrame:
    """One row per window: the conversation, ``window`` (0 first), ``formatted``, ``n_repeated`` (turns at its start that
    an earlier window held) and ``loss`` (character spans ``from``, ``to`` of the assistant texts it holds first).

    Turns are in the order of ``turn``, then role, then text; rows without a turn number come first; repeated rows are
    turns of their own. A null role or text is empty. A first turn of the role ``system`` is the system turn. A null
    conversation id is a conversation. No rows give no windows; other columns play no part.
    """
    only = turns.select(
        F.col(f"`{conv_col}`").alias("conv"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        F.lit(0).alias("tie"),
    )
    placed = written(_placed(only, budget), "chat-turns")
    spread = placed.withColumn("last", F.max("span").over(Window.partitionBy("conv"))).withColumn(
        "window",
        F.explode(
            F.when(F.col("system"), F.sequence(F.lit(0).cast("long"), F.col("last")))
            .when(F.col("history"), F.array("span", F.col("span") + 1))
            .otherwise(F.array("span"))
        ),
    )
    head = F.concat(F.lit(OPEN), escape(F.col("role"), _ROLE_ESCAPES), F.lit("\n"))
    turn = F.struct(
        "place",
        head.alias("head"),
        escape(F.col("text")).alias("body"),
        (F.col("window") != F.col("span")).alias("again"),
        (F.col("role") == "assistant").alias("learnt"),
    )
    windows = spread.groupBy("conv", "window").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,to:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.char_length(t["head"]) + F.char_length(t["body"]) + len(CLOSE)).alias("at"),
            F.when(
                t["learnt"] & ~t["again"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.char_length(t["head"])).alias("from"),
                            (acc["at"] + F.char_length(t["head"]) + F.char_length(t["body"])).alias("to"),
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    again = F.size(F.filter("turns", lambda t: t["again"]))
    return windows.select(
        F.col("conv").alias(conv_col), "window", text.alias("formatted"), again.alias("n_repeated"), spans.alias("loss")
    )


def read_chat(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What windows hold for the first time, from their text and spans alone: the conversation, ``window``, ``turns``
    (role and text of each) and ``learnt`` (the texts under the mask), all unescaped."""
    whole = F.split(F.col("formatted"), CLOSE)
    new = F.slice(whole, F.col("n_repeated") + 1, F.size(whole) - 1 - F.col("n_repeated"))

    def turn(t: Column) -> Column:
        cut = F.instr(t, "\n")
        role = F.substring(t, F.lit(len(OPEN) + 1), cut - len(OPEN) - 1)
        return F.struct(
            unescape(role, _ROLE_ESCAPES).alias("role"), unescape(F.substring(t, cut + 1, F.char_length(t))).alias("text")
        )

    learnt = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["from"] + 1, s["to"] - s["from"])))
    return windows.select(conv_col, "window", F.transform(new, turn).alias("turns"), learnt.alias("learnt"), F.char_length("formatted").alias("n_chars"))


def chat_report(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation, read back from its windows: counts and digests of its turns and of what is learnt.

    A digest needs all text of a conversation in order, so a conversation is one row here; the windows are not bound to
    that."""
    read = read_chat(windows, conv_col)
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = read.select(
        F.col(conv_col).alias("conv"),
        F.struct("window", lines.alias("turns"), F.array_join("learnt", "").alias("learnt")).alias("part"),
        F.size("turns").alias("n"),
        "n_chars",
    )
    whole = parts.groupBy("conv").agg(
        F.sum("n").cast("long").alias("n_turns"),
        F.sum("n_chars").cast("long").alias("formatted_chars"),
        F.sort_array(F.collect_list("part")).alias("parts"),
    )
    turns = F.array_join(F.col("parts.turns"), "")
    learnt = F.array_join(F.col("parts.learnt"), "")
    return whole.select(
        F.col("conv").alias(conv_col),
        "n_turns",
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
