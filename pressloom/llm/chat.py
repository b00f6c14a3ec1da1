"""Chat formatting with typed content parts, as DataFrame operations only.

A turn's content is an array of parts (type, text, ref, size). A visitor over the parts writes text as it is, escaped, and
any other part as the placeholder of its type; the n-th placeholder of a conversation belongs to its n-th attachment, which
keeps the reference, the turn and the number of tokens that the placeholder stands for.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.llm.tables import ready

PART = "struct<type:string,text:string,ref:string,size:double>"


@dataclass(frozen=True)
class Template:
    """Control strings; strings that texts must not hold as they are; units of an attachment's size per token.

    Every control string begins with `<|`, which is reserved, so none can come from a text.
    """

    turn: str = "<|turn|>"
    says: str = "<|says|>"
    end: str = "<|end|>"
    reserved: tuple[str, ...] = ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    learned: tuple[str, ...] = ("assistant",)
    #: type: (size units per token, tokens at least); an image's size is in pixels, audio's in seconds, a document's in characters
    attachments: dict[str, tuple[float, int]] = field(default_factory=lambda: {"image": (784.0, 16), "audio": (0.04, 1), "document": (4.0, 1)})

    def placeholder(self, kind: Column) -> Column:
        return F.concat(F.lit("<|"), kind, F.lit("|>"))


def escape(text: Column, template: Template) -> Column:
    """Backslashes are doubled and one is put behind the first character of each reserved string."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for word in template.reserved:
        out = F.replace(out, F.lit(word), F.lit(word[0] + "\\" + word[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """A plain text as the only part of a turn."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("double").alias("size")))


def _visit(part: Column, template: Template) -> Column:
    """(written, is_text, type, ref, tokens) of one part; an unknown type is written as a document."""
    kind = F.coalesce(part["type"], F.lit("text"))
    known = F.when(kind.isin(*template.attachments), kind).otherwise(F.lit("document"))
    size = F.coalesce(part["size"], F.lit(0.0))
    tokens = F.lit(None).cast("bigint")
    for name, (unit, least) in template.attachments.items():
        tokens = F.when(known == name, F.greatest(F.lit(least).cast("bigint"), F.ceil(size / unit))).otherwise(tokens)
    is_text = kind == "text"
    return F.struct(
        F.when(is_text, escape(F.coalesce(part["text"], F.lit("")), template)).otherwise(template.placeholder(known)).alias("written"),
        is_text.alias("is_text"),
        known.alias("type"),
        part["ref"].alias("ref"),
        tokens.alias("tokens"),
    )


def format_chat(
    conversations: DataFrame, parts: Column | None = None, template: Template = Template(), conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, n_turns, formatted, loss, attachments, expanded_tokens), one row for each conversation.

    Turns are in the order of `turn`, null first, ties by role and content. `loss` are the spans [first, last), in code
    points of `formatted`, of the text parts of learned roles. `expanded_tokens` sums the attachments' tokens. A null role
    or text is empty; a null or empty list of parts is a turn without content; rows with a null conv_id are one
    conversation; repeated rows are turns of their own. Other columns play no part. A conversation is one row of the result,
    so its turns meet in one task; conversations of one hot first turn or text do not.
    """
    ready(conversations.sparkSession)
    content = text_part(F.col(f"`{text}`")) if parts is None else F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    rows = conversations.select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), content.alias("parts")
    )
    visited = rows.withColumn("visited", F.transform("parts", lambda p: _visit(p, template)))
    head = F.concat(F.lit(template.turn), escape(F.col("role"), template), F.lit(template.says))
    written = visited.withColumns({"head": head, "body": F.array_join(F.transform("visited", lambda v: v["written"]), "")})
    written = written.withColumn("written", F.concat("head", "body", F.lit(template.end)))
    span = "array<struct<first:bigint,last:bigint>>"
    learned = F.col("role").isin(*template.learned)
    spans = F.aggregate(
        "visited",
        F.struct(F.length("head").cast("bigint").alias("at"), F.array().cast(span).alias("spans")),
        lambda s, v: F.struct(
            (s["at"] + F.length(v["written"])).alias("at"),
            F.when(
                v["is_text"] & learned,
                F.concat(s["spans"], F.array(F.struct(s["at"].alias("first"), (s["at"] + F.length(v["written"])).alias("last")))),
            )
            .otherwise(s["spans"])
            .alias("spans"),
        ),
    )["spans"]
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    placed = written.select("conv_id", "turn", "role", "parts", "visited", "written", spans.alias("spans"), F.row_number().over(order).alias("n"), F.coalesce(F.sum(F.length("written")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("at"))
    one = F.struct(
        "n",
        "written",
        F.transform("spans", lambda s: F.struct((s["first"] + F.col("at")).alias("first"), (s["last"] + F.col("at")).alias("last"))).alias("spans"),
        F.transform(
            F.filter("visited", lambda v: ~v["is_text"]),
            lambda v: F.struct(v["type"].alias("type"), v["ref"].alias("ref"), (F.col("n") - 1).alias("turn"), v["tokens"].alias("tokens")),
        ).alias("attachments"),
    )
    turns = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    return turns.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["written"]), "").alias("formatted"),
        F.flatten(F.transform("turns", lambda t: t["spans"])).alias("loss"),
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns (role, text) of a formatted conversation; placeholders stay in the text."""
    pieces = F.split(formatted, "\\Q" + template.turn + "\\E")
    body = lambda p: F.substring_index(F.substring_index(p, template.says, -1), template.end, 1)
    return F.transform(
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda p: F.struct(unescape(F.substring_index(p, template.says, 1)).alias("role"), unescape(body(p)).alias("text")),
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["first"] + 1, s["last"] - s["first"]))), "")
