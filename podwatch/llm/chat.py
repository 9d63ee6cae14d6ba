"""Chat formatting with Spark expressions only.

A conversation's turns are collected, sorted, and neighbours of one role merged; the result is one string in
which marks that no text can contain open, separate and close messages. Text is escaped reversibly: the
escape character becomes a pair, and so does every control string. The loss mask is a list of spans of the
formatted string, one for each assistant text, marks left out.

One conversation is one string and so one row; it may hold what a string may, 2 GB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, BETWEEN, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROLS = (START, BETWEEN, END, "<|endoftext|>", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>")
ESCAPE = "~"
LEARNED = "assistant"
# "~0" is the escape character itself, then come the line feed (for roles) and the control strings.
_CODES = [(ESCAPE, "~0"), ("\n", "~n"), *((c, f"~{chr(97 + k)}") for k, c in enumerate(CONTROLS))]


def escaped(text: Column, role: bool = False) -> Column:
    for plain, code in _CODES:
        if plain != "\n" or role:
            text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(_CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) for every conv_id of ``turns`` (conv_id, turn, role, text).

    Turns are ordered by turn, NULL first, then by role and text. A NULL text is empty, a NULL role is the
    empty role, and rows without conv_id are one conversation. Repeated rows are turns of their own. Other columns
    are ignored. An empty table gives an empty result. ``loss_spans`` has (start, length) in code points of
    the formatted string, counted from 0, in order.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            escaped(F.coalesce("role", F.lit("")), role=True).alias("role"),
            escaped(F.coalesce("text", F.lit(""))).alias("text"),
        ).alias("t"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    merged = F.expr(
        """aggregate(turns, cast(array() as array<struct<role: string, texts: array<string>>>),
             (runs, t) -> CASE WHEN size(runs) > 0 AND element_at(runs, -1).role = t.role
               THEN concat(slice(runs, 1, size(runs) - 1),
                           array(named_struct('role', t.role, 'texts', concat(element_at(runs, -1).texts, array(t.text)))))
               ELSE concat(runs, array(named_struct('role', t.role, 'texts', array(t.text)))) END)"""
    )
    chats = chats.select("conv_id", merged.alias("runs"))
    body = F.transform("runs", lambda r: F.concat(F.lit(START), r["role"], F.lit("\n"), F.array_join(r["texts"], BETWEEN), F.lit(END + "\n")))
    spans = F.expr(
        f"""aggregate(runs, named_struct('at', 0L, 'spans', cast(array() as array<struct<start: bigint, length: bigint>>)),
              (s, r) -> aggregate(r.texts,
                named_struct('at', s.at + {len(START) + 1} + length(r.role) - {len(BETWEEN)}, 'spans', s.spans),
                (x, text) -> named_struct(
                  'at', x.at + {len(BETWEEN)} + length(text),
                  'spans', CASE WHEN r.role = '{LEARNED}'
                    THEN concat(x.spans, array(named_struct('start', x.at + {len(BETWEEN)}, 'length', cast(length(text) as bigint))))
                    ELSE x.spans END),
                x -> named_struct('at', x.at + {len(END) + 1}, 'spans', x.spans)),
              s -> s.spans)"""
    )
    return chats.select("conv_id", F.array_join(body, "").alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The frame of :func:`format_conversations` with turns (role, text) and loss_text, read from its string."""

    def of(message: Column) -> Column:
        head = F.substring_index(message, "\n", 1)
        body = F.substring(message, F.length(head) + 2, F.length(message) - F.length(head) - F.lit(len(END) + 2))
        texts = F.split(body, BETWEEN.replace("|", r"\|"))
        return F.transform(texts, lambda t: F.struct(unescaped(head).alias("role"), unescaped(t).alias("text")))

    messages = F.split("formatted", START.replace("|", r"\|"))
    turns = F.flatten(F.transform(F.slice(messages, 2, F.greatest(F.size(messages) - 1, F.lit(0))), of))
    learned = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"].cast("int") + 1, s["length"].cast("int"))))
    return formatted.select("*", turns.alias("turns"), F.array_join(learned, "").alias("loss_text"))
