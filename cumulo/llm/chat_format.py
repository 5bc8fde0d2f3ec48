"""Chat formatting with typed content parts (DataFrame functions only).

A message is a role and an array of parts `struct<type, text, ref, units>`. The visitor walks the
parts of a turn in order: a text part becomes its escaped text, an image, audio or document part
(or any other type) becomes a placeholder, recorded as an attachment with its reference and the
number of tokens it stands for once expanded: fixed + per_unit * units of its type (`EXPAND`;
units are tiles, seconds or pages). Turns are marked as

    <|im_start|>role\\n ... <|im_end|>\\n

and escaping is reversible: every `<` of a text or role is followed by a backslash, so `<|` occurs
only in the template's own marks; in roles also % and line feeds are written as %25 and %0A.

Loss spans are the text parts of the trained roles, as (turn, offset, length) in code points; the
offset counts from the end of the turn's `<|im_start|>`. `read_back` rebuilds roles, texts and the
text under the loss mask from the formatted string and the spans alone.

Defined cases: NULL text is empty, NULL role is empty, NULL parts array is no part, NULL units is
0; a part of NULL type is text; turns are ordered by (turn, role, text), NULL turns first, repeated
rows stay; rows of NULL conversation id form one conversation; an empty table gives an empty result;
other columns are not looked at. A conversation is one output string, so its turns meet in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END, AFTER = "<|im_start|>", "<|im_end|>", "\n"
#: Tokens that a part stands for: fixed, and for each unit.
EXPAND = {"image": (2, 256), "audio": (2, 25), "document": (2, 512)}
PART = "struct<type:string,text:string,ref:string,units:bigint>"


def text_part(text: Column) -> Column:
    """A one-part array that holds plain text."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("bigint").alias("units")))


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<"), F.lit("<\\"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<\\"), F.lit("<"))


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _kind(p: Column) -> Column:
    return F.coalesce(p["type"], F.lit("text"))


def _render(p: Column) -> Column:
    return F.when(_kind(p) == "text", escape(F.coalesce(p["text"], F.lit("")))).otherwise(
        F.concat(F.lit("<|"), F.regexp_replace(_kind(p), "[^A-Za-z0-9_]", "_"), F.lit("|>")))


def _expanded(p: Column) -> Column:
    n = F.lit(1).cast("bigint")
    for kind, (fixed, per_unit) in EXPAND.items():
        n = F.when(_kind(p) == kind, F.lit(fixed) + F.lit(per_unit) * F.coalesce(p["units"], F.lit(0))).otherwise(n)
    return n


def visit_parts(messages: DataFrame, role_col: str = "role", parts_col: str = "parts") -> DataFrame:
    """Flatten each message's parts: adds _role, _content, _texts (spans of text parts in the content)
    and _attachments to the row."""
    parts = F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>"))
    seen = messages.withColumn("_role", escape_role(F.coalesce(F.col(role_col), F.lit("")))) \
                   .withColumn("_pieces", F.transform(parts, lambda p: F.struct(
                       _kind(p).alias("type"), _render(p).alias("text"), p["ref"].alias("ref"),
                       _expanded(p).alias("n_tokens"))))
    spans = F.aggregate(
        "_pieces",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<offset:int,length:int>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.char_length(p["text"])).alias("at"),
            F.when(p["type"] == "text", F.concat(acc["spans"], F.array(F.struct(
                acc["at"].alias("offset"), F.char_length(p["text"]).alias("length"))))).otherwise(
                acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    marked = F.transform("_pieces", lambda p, i: F.struct(i.alias("part"), p["type"].alias("type"),
                                                          p["ref"].alias("ref"), p["n_tokens"].alias("n_tokens")))
    return (seen.withColumn("_content", F.array_join(F.transform("_pieces", lambda p: p["text"]), ""))
            .withColumn("_texts", spans)
            .withColumn("_attachments", F.filter(marked, lambda a: a["type"] != "text")).drop("_pieces"))


def format_chats(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 parts_col: str = "parts", trained_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: id, n_turns, formatted, loss_spans, attachments, attachment_tokens."""
    named = messages.select(F.col(conv_col).alias("_conv"), F.col(turn_col).alias("_turn"),
                            F.col(role_col).alias("_r"), F.col(parts_col).alias("_parts"))
    flat = visit_parts(named, "_r", "_parts")
    turns = flat.groupBy("_conv").agg(F.sort_array(F.collect_list(F.struct(
        "_turn", "_role", "_content", "_texts", "_attachments",
        F.coalesce(F.col("_r").isin(*trained_roles), F.lit(False)).alias("_trained")))).alias("t"))
    text = F.array_join(F.transform("t", lambda x: F.concat(
        F.lit(START), x["_role"], F.lit("\n"), x["_content"], F.lit(END + AFTER))), "")
    spans = F.flatten(F.transform("t", lambda x, i: F.transform(
        F.when(x["_trained"], x["_texts"]).otherwise(F.array().cast("array<struct<offset:int,length:int>>")),
        lambda s: F.struct(i.alias("turn"), (s["offset"] + F.char_length(x["_role"]) + 1).alias("offset"),
                           s["length"].alias("length")))))
    files = F.flatten(F.transform("t", lambda x, i: F.transform(x["_attachments"], lambda a: F.struct(
        i.alias("turn"), a["part"].alias("part"), a["type"].alias("type"), a["ref"].alias("ref"),
        a["n_tokens"].alias("n_tokens")))))
    return turns.select(
        F.col("_conv").alias(conv_col), F.size("t").cast("long").alias("n_turns"), text.alias("formatted"),
        spans.alias("loss_spans"), files.alias("attachments"),
        F.aggregate(files, F.lit(0).cast("long"), lambda s, a: s + a["n_tokens"]).alias("attachment_tokens"))


def read_back(chats: DataFrame) -> DataFrame:
    """Adds `turns` (array of role, text as written) and `loss_text`, both from `formatted` and `loss_spans`."""
    tail = len(END) + len(AFTER)
    segments = F.slice(F.split("formatted", "<\\|im_start\\|>"), F.lit(2), F.greatest(F.size(F.split(
        "formatted", "<\\|im_start\\|>")) - 1, F.lit(0)))
    role = lambda s: F.substring_index(s, "\n", 1)
    body = lambda s: F.substr(s, F.char_length(role(s)) + 2,
                              F.char_length(s) - F.char_length(role(s)) - 1 - tail)
    got = chats.withColumn("_segments", segments)
    return (got.withColumn("turns", F.transform("_segments", lambda s: F.struct(
                unescape_role(role(s)).alias("role"), unescape(body(s)).alias("text"))))
            .withColumn("loss_text", F.array_join(F.transform("loss_spans", lambda x: unescape(F.substr(
                F.get("_segments", x["turn"]), x["offset"] + 1, x["length"]))), "")).drop("_segments"))
