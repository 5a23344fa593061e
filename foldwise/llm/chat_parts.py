"""Chat formatting with typed content parts (DataFrame functions only).

A message is an array of parts ``struct<type, text, ref, units>``.  The visitor
flattens the parts in order: text parts are escaped, image / audio / document
parts become a placeholder each, and every such part is recorded as an
attachment (type, reference, expanded token count).  The n-th placeholder of a
conversation belongs to its n-th attachment.

Template: a turn of the assistant is ``<s>role NEWLINE body</s>``, any other turn
``[INST]role NEWLINE body[/INST]``.  Control strings inside texts are replaced
reversibly by the escape sign and a code; the escape sign itself gets code 0, so
``unescape(escape(x)) == x`` and no escaped text holds a control string.  The
loss mask is a list of (start, length) spans in code points: the bodies of the
assistant's turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ESC = "␛"
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: fixed values of the template; the code of a control string is its place in the list, from 1
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", *PLACEHOLDER.values()]
NEWLINE_CODE = "n"
#: tokens that one unit of a part expands to: an image tile, a second of audio, a page
TOKENS_PER_UNIT = {"image": 64.0, "audio": 12.5, "document": 256.0}
PART = "struct<type:string,text:string,ref:string,units:double>"


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit(ESC), F.lit(ESC + "0"))
    for i, s in enumerate(CONTROL, 1):
        c = F.replace(c, F.lit(s), F.lit(f"{ESC}{i}"))
    return c


def unescape(c: Column) -> Column:
    for i, s in enumerate(CONTROL, 1):
        c = F.replace(c, F.lit(f"{ESC}{i}"), F.lit(s))
    return F.replace(c, F.lit(ESC + "0"), F.lit(ESC))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit(ESC + NEWLINE_CODE))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit(ESC + NEWLINE_CODE), F.lit("\n")))


def text_part(text: str | Column) -> Column:
    """A message of one text part."""
    c = F.col(text) if isinstance(text, str) else text
    return F.array(F.struct(F.lit("text").alias("type"), c.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("double").alias("units")))


def visit(parts: Column) -> Column:
    """Flattened body: escaped text and placeholders, in order (unknown or NULL types count as text)."""
    def one(p: Column) -> Column:
        out = escape(F.coalesce(p["text"], F.lit("")))
        for kind, mark in PLACEHOLDER.items():
            out = F.when(p["type"] == kind, F.lit(mark)).otherwise(out)
        return out
    return F.array_join(F.transform(F.coalesce(parts, F.array().cast(f"array<{PART}>")), one), "")


def attachments(parts: Column) -> Column:
    """The attachment parts: struct(type, ref, n_tokens), in order; NULL units expand to 0 tokens."""
    kinds = F.array(*[F.lit(k) for k in PLACEHOLDER])
    rate = lambda p: F.coalesce(*[F.when(p["type"] == k, F.lit(v)) for k, v in TOKENS_PER_UNIT.items()])
    held = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")),
                    lambda p: F.coalesce(F.array_contains(kinds, p["type"]), F.lit(False)))
    return F.transform(held, lambda p: F.struct(
        p["type"].alias("type"), p["ref"].alias("ref"),
        F.ceil(F.coalesce(p["units"], F.lit(0.0)) * rate(p)).cast("long").alias("n_tokens")))


def format_chats(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 parts: str = "parts") -> DataFrame:
    """(conv_id, n_turns, formatted, loss_spans, attachments, attachment_tokens), one row per conversation.

    Turns are ordered by turn number, ties by role, then body (NULL first); a NULL
    role counts as the empty role, NULL parts or text as empty text, and rows of
    a NULL conversation form one conversation; repeated rows are turns of their
    own.  Other columns are ignored.  A conversation is one output string, so its
    turns meet in one row by nature of the result."""
    who = F.coalesce(F.col(f"`{role}`"), F.lit(""))
    helper = who == "assistant"
    rows = messages.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), who.alias("role"),
                           visit(F.col(f"`{parts}`")).alias("body"), attachments(F.col(f"`{parts}`")).alias("att"),
                           helper.alias("learn"))
    head = F.concat(F.when(F.col("learn"), F.lit(CONTROL[0])).otherwise(F.lit(CONTROL[2])), escape_role(F.col("role")), F.lit("\n"))
    tail = F.when(F.col("learn"), F.lit(CONTROL[1])).otherwise(F.lit(CONTROL[3]))
    rows = rows.select("conv_id", "turn", "role", "body", "att", "learn", head.alias("head"),
                       F.concat(head, F.col("body"), tail).alias("piece"))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "body")
    placed = (rows.withColumn("at", F.row_number().over(order))
              .withColumn("start", F.sum(F.length("piece")).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
                          - F.length("piece") + F.length("head")))
    turns = F.array_sort(F.collect_list(F.struct("at", "piece", "learn", "start", F.length("body").alias("len"), "att")))
    got = placed.groupBy("conv_id").agg(turns.alias("turns"))
    return got.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learn"]), lambda t: F.struct(
            t["start"].alias("start"), t["len"].cast("long").alias("length"))).alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: t["att"])).alias("attachments"),
    ).withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["n_tokens"]))


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of struct(role, text), control strings restored."""
    pieces = F.filter(F.split(formatted, r"(?<=</s>)|(?<=\[/INST\])"), lambda x: x != "")

    def one(p: Column) -> Column:
        mine = F.startswith(p, F.lit(CONTROL[0]))
        lead = F.when(mine, len(CONTROL[0])).otherwise(len(CONTROL[2]))
        last = F.when(mine, len(CONTROL[1])).otherwise(len(CONTROL[3]))
        inner = F.substring(p, lead + 1, F.length(p) - lead - last)
        cut = F.locate("\n", inner)
        return F.struct(unescape_role(F.substring(inner, F.lit(1), cut - 1)).alias("role"),
                        unescape(F.substring(inner, cut + 1, F.length(inner))).alias("text"))
    return F.transform(pieces, one)


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, control strings restored."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
