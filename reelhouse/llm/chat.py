"""Chat formatting (native): typed content parts, a reversible template, a loss mask.

A turn holds an array of parts (type, text, ref, units). A visitor flattens
them in order: text is escaped, every other type becomes a placeholder
``<|type:turn.part|>`` and an attachment entry with its reference and expanded
token count. Control strings all start with ``<|``; inside texts and roles a
backslash becomes two and ``<|`` becomes ``<\\|``, so ``<|`` never occurs in
escaped text and ``unescape`` gives the original back.

    <|turn|>role<|says|>part<|part|>part<|end|>

``format_conversations`` returns one row per conversation: the formatted text,
the loss mask (spans of the text parts of the trained roles, in code points of
the formatted text) and the attachments. ``read_turns`` and ``loss_texts``
read an output back.

Turns are ordered by turn, then role, then text, so repeated rows and ties
have a fixed place; a null turn comes first. Null roles and texts are empty; a null array of
parts is a turn without parts; a null conversation id is one conversation. An
unknown part type is an attachment of 0 tokens. Very long texts are formatted
whole. Extra columns are ignored. An
empty table gives an empty result. A conversation is one output row, so all
its turns meet in one task by definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN, SAYS, PART, END = "<|turn|>", "<|says|>", "<|part|>", "<|end|>"
TRAINED_ROLES = ("assistant",)
# Tokens that one unit of an attachment expands to: image tiles, audio seconds, document pages.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 512}

PARTS_TYPE = "array<struct<type: string, text: string, ref: string, units: bigint>>"


def escape(text: Column) -> Column:
    twice = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(twice, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_parts(text: str | Column) -> Column:
    """Parts of a plain text turn."""
    text = F.col(text) if isinstance(text, str) else text
    null = lambda kind: F.lit(None).cast(kind)
    return F.array(
        F.struct(F.lit("text").alias("type"), text.alias("text"), null("string").alias("ref"), null("bigint").alias("units"))
    )


def _unit_tokens(part: Column, unit_tokens: dict[str, int]) -> Column:
    per = F.lit(0)
    for kind, n in unit_tokens.items():
        per = F.when(part["type"] == kind, n).otherwise(per)
    return (F.coalesce(part["units"], F.lit(1)) * per).cast("long")


def _visit(part: Column, turn: Column, at: Column) -> Column:
    """The flattened form of a part."""
    place = F.concat(
        F.lit("<|"), escape(part["type"]), F.lit(":"), turn.cast("string"), F.lit("."), at.cast("string"), F.lit("|>")
    )
    return F.when(part["type"] == "text", escape(part["text"])).otherwise(place)


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts_col: str | Column = "parts",
    trained_roles: tuple[str, ...] = TRAINED_ROLES,
    unit_tokens: dict[str, int] = UNIT_TOKENS,
) -> DataFrame:
    """conv_id, formatted, loss array<turn, turn_start, start, end>, attachments, attachment_tokens."""
    parts = F.col(parts_col) if isinstance(parts_col, str) else parts_col
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(parts.cast(PARTS_TYPE), F.array().cast(PARTS_TYPE)).alias("parts"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    rows = rows.withColumn("no", F.row_number().over(order) - 1)
    rows = rows.withColumn("flat", F.transform("parts", lambda p, i: _visit(p, F.col("no"), i)))
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(SAYS))
    rows = rows.withColumn("piece", F.concat(head, F.array_join("flat", PART), F.lit(END)))
    rows = rows.withColumn(
        "start", F.coalesce(F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    # Start of each part: the head, the parts before it and their separators.
    before = lambda i: F.aggregate(F.slice("flat", 1, i), F.lit(0), lambda acc, x: acc + F.length(x) + len(PART))
    spans = F.transform(
        F.sequence(F.lit(0), F.size("parts") - 1),
        lambda i: F.struct(
            (F.col("start") + F.length(head) + before(i)).alias("start"),
            F.get("flat", i).alias("flat"),
            F.get("parts", i)["type"].alias("type"),
        ),
    )
    trained = F.col("role").isin(*trained_roles) & (F.size("parts") > 0)
    loss = F.when(
        trained,
        F.transform(
            F.filter(spans, lambda s: s["type"] == "text"),
            lambda s: F.struct(
                F.col("no").alias("turn"),
                F.col("start").cast("long").alias("turn_start"),
                s["start"].cast("long").alias("start"),
                (s["start"] + F.length(s["flat"])).cast("long").alias("end"),
            ),
        ),
    )
    media = F.filter(
        F.transform(
            "parts",
            lambda p, i: F.struct(
                F.col("no").alias("turn"),
                i.alias("part"),
                p["type"].alias("type"),
                p["ref"].alias("ref"),
                _unit_tokens(p, unit_tokens).alias("tokens"),
                F.get("flat", i).alias("placeholder"),
            ),
        ),
        lambda m: ~m["type"].eqNullSafe(F.lit("text")),
    )
    rows = rows.select("conv_id", F.struct("no", "piece", loss.alias("loss"), media.alias("media")).alias("t"))
    # The window has dealt the rows by conversation already: no second exchange.
    told = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    flat = lambda name: F.flatten(F.filter(F.col(f"t.{name}"), lambda x: x.isNotNull()))
    return told.select(
        "conv_id",
        F.array_join("t.piece", "").alias("formatted"),
        flat("loss").alias("loss"),
        flat("media").alias("attachments"),
    ).withColumn(
        "attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda acc, m: acc + m["tokens"])
    )


def read_pieces(formatted: Column) -> Column:
    """The turns of a formatted text, each without its end mark."""
    pieces = F.split(formatted, r"<\|end\|>", -1)
    return F.slice(pieces, 1, F.size(pieces) - 1)


def read_turns(pieces: Column) -> Column:
    """array<role, text> from ``read_pieces``, unescaped."""
    role = lambda p: F.substring_index(p, SAYS, 1)
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substr(role(p), F.lit(len(OPEN) + 1))).alias("role"),
            unescape(F.substr(p, F.length(role(p)) + len(SAYS) + 1)).alias("text"),
        ),
    )


def loss_texts(pieces: Column, loss: Column) -> Column:
    """Unescaped texts under the loss mask, in order."""
    return F.transform(
        loss,
        lambda s: unescape(
            F.substr(F.get(pieces, s["turn"]), (s["start"] - s["turn_start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        ),
    )
