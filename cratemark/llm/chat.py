r"""Chat formatting: typed content parts become one string per conversation.

    <|turn|>role<|says|>content<|end|><|turn|>...

A turn's content is an array of typed parts. ``visit_parts`` goes over them in
order: text is escaped, an image, audio or document part leaves a placeholder
(``<|image|>``) and is noted as an attachment with its reference and the number
of tokens that it will expand to. The n-th placeholder of a conversation belongs
to its n-th attachment.

Control strings within texts are made harmless by a backslash after their first
character (``<\/s>``); one that already has backslashes there gets one more, so
that taking one away gives the text back, whatever it was.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
ATTACHED = ("image", "audio", "document")

# Control strings after their first character, as regular expressions.
_AFTER_LESS = (r"/?s>", r"</?SYS>>", r"\|[^|<>\[\]]*\|>")
_AFTER_BRACKET = (r"/?INST\]",)
CONTROL_HEAD = r"(<|\[)"
CONTROL_REST = "(" + "|".join((*_AFTER_LESS, *_AFTER_BRACKET)) + ")"
ESCAPE = CONTROL_HEAD + r"(\\*)" + CONTROL_REST
UNESCAPE = CONTROL_HEAD + r"\\(\\*)" + CONTROL_REST

PART = (
    "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
)
# Tokens of attachments: pixels to a side of an image token, audio tokens a
# second, tokens a page.
RATES = {"patch": 28, "per_second": 25, "per_page": 576}


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def text_parts(text: Column) -> Column:
    """A plain text as its single part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).cast(
        f"array<struct<type:string,text:string>>"
    )


def _field(part: Column, fields: Sequence[str], name: str, kind: str) -> Column:
    return part[name].cast(kind) if name in fields else F.lit(None).cast(kind)


def visit_parts(
    parts: Column, fields: Sequence[str], rates: Mapping[str, float] = RATES
) -> tuple[Column, Column]:
    """The content of a turn, and its attachments in order.

    ``parts`` is an array of structs with at least ``type`` and ``text``; of
    ``ref``, ``width``, ``height``, ``seconds`` and ``pages`` those named in
    ``fields``. Types are compared in lower case. A part of any other type, or
    none, counts as text; a null part, a null text and a null array are empty.
    A measure that is missing or negative counts as 0.
    """

    def measure(part: Column, name: str) -> Column:
        return F.greatest(F.lit(0.0), F.coalesce(_field(part, fields, name, "double"), F.lit(0.0)))

    def kind(part: Column) -> Column:
        return F.lower(part["type"])

    def is_attached(part: Column) -> Column:
        return F.coalesce(kind(part).isin(*ATTACHED), F.lit(False))

    def content(part: Column) -> Column:
        return F.when(is_attached(part), F.concat(F.lit("<|"), kind(part), F.lit("|>"))).otherwise(
            escaped(F.coalesce(part["text"], F.lit("")))
        )

    def tokens(part: Column) -> Column:
        patch = F.lit(float(rates["patch"]))
        return (
            F.when(
                kind(part) == "image",
                F.ceil(measure(part, "width") / patch) * F.ceil(measure(part, "height") / patch),
            )
            .when(kind(part) == "audio", F.ceil(measure(part, "seconds") * rates["per_second"]))
            .otherwise(F.ceil(measure(part, "pages") * rates["per_page"]))
            .cast("long")
        )

    def attachment(part: Column) -> Column:
        return F.struct(
            kind(part).alias("type"),
            _field(part, fields, "ref", "string").alias("ref"),
            tokens(part).alias("tokens"),
        )

    nothing = F.array().cast("array<struct<type:string,ref:string,tokens:bigint>>")
    return (
        F.coalesce(F.array_join(F.transform(parts, content), ""), F.lit("")),
        F.coalesce(F.transform(F.filter(parts, is_attached), attachment), nothing),
    )


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    content_col: str = "text",
    learned_roles: Sequence[str] = ("assistant",),
    rates: Mapping[str, float] = RATES,
) -> DataFrame:
    """One row a conversation: ``conv_col``, formatted, loss_spans, attachments,
    attached_tokens.

    ``content_col`` holds plain texts or arrays of parts (see ``visit_parts``).
    ``loss_spans`` are the places (start, end; code points, the end excluded) of
    the contents of ``learned_roles`` within ``formatted``.

    Turns go by ``turn_col``, nulls first; ties by role, then by content, so that
    rows that are equal change nothing by changing places. Rows without a
    conversation make one of their own. A null role is an empty one and null
    texts are empty; an empty table gives no rows. Columns that are not named
    are not read.

    A conversation becomes one string, so its turns meet in one task; running
    sums and the collection there are Spark's and go by one sort.
    """
    kind = turns.schema[content_col].dataType
    if kind.typeName() == "string":
        parts, fields = text_parts(turns[content_col]), ("type", "text")
    else:
        parts, fields = turns[content_col], kind.elementType.fieldNames()
    content, attachments = visit_parts(parts, fields, rates)
    role = F.coalesce(turns[role_col], F.lit(""))
    head = F.concat(F.lit(TURN), escaped(role), F.lit(SAYS))
    rows = turns.select(
        turns[conv_col].alias("_conv"),
        turns[turn_col].alias("_turn"),
        role.alias("_role"),
        head.alias("_head"),
        content.alias("_content"),
        attachments.alias("_attached"),
    )
    order = Window.partitionBy("_conv").orderBy(
        F.col("_turn").asc_nulls_first(), "_role", "_content", F.to_json("_attached")
    )
    size = F.length("_head") + F.length("_content") + len(END)
    placed = (
        rows.withColumn("_at", F.row_number().over(order))
        .withColumn("_ends", F.sum(size.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_stop", F.col("_ends") - len(END))
        .withColumn("_start", F.col("_stop") - F.length("_content"))
    )
    span = F.when(
        F.col("_role").isin(*learned_roles),
        F.struct(F.col("_start").alias("start"), F.col("_stop").alias("end")),
    )
    grouped = placed.groupBy("_conv").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "_at",
                    F.concat("_head", "_content", F.lit(END)).alias("piece"),
                    span.alias("span"),
                    F.col("_attached").alias("attached"),
                )
            )
        ).alias("_rows")
    )
    spans = F.filter(F.col("_rows.span"), lambda s: s.isNotNull())
    return grouped.select(
        F.col("_conv").alias(conv_col),
        F.array_join("_rows.piece", "").alias("formatted"),
        spans.alias("loss_spans"),
        F.flatten("_rows.attached").alias("attachments"),
    ).withColumn(
        "attached_tokens",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text): what a formatted string says, unescaped.
    Placeholders of attachments stay in the text."""
    turns = F.slice(F.split(formatted, r"<\|turn\|>"), 2, 1 << 30)
    return F.transform(
        turns,
        lambda t: F.transform(
            F.array(F.split(t, r"<\|says\|>|<\|end\|>")),
            lambda p: F.struct(
                unescaped(F.get(p, F.lit(0))).alias("role"), unescaped(F.get(p, F.lit(1))).alias("text")
            ),
        )[0],
    )


def read_spans(formatted: Column, spans: Column) -> Column:
    """The text within ``spans``, unescaped, nothing between."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescaped(
                F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
            ),
        ),
        "",
    )
