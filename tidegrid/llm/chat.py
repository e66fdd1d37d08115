"""Chat formatting: typed content parts flattened into one templated text with a loss mask."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import pick

# fixed values of the template
START, END, LINE = "<|im_start|>", "<|im_end|>\n", "<|nl|>"

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    """``text`` without any control string: backslashes are doubled, ``<|`` becomes ``<\\|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def escape_role(role: Column) -> Column:
    """A role stays on its line, so a line break in it becomes a control string of its own."""
    return F.replace(escape(role), F.lit("\n"), F.lit(LINE))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(LINE), F.lit("\n")))


#: Tokens that an attachment stands for: images by 14-pixel patches merged two by two, audio by 25
#: frames a second, documents by 256 tokens a page. An unknown size counts as one unit.
EXPANSIONS: dict[str, Callable[[Column], Column]] = {
    "image": lambda p: F.ceil(F.coalesce(p["width"], F.lit(28)) / 28) * F.ceil(F.coalesce(p["height"], F.lit(28)) / 28),
    "audio": lambda p: F.greatest(F.ceil(F.coalesce(p["seconds"], F.lit(0.04)) * 25), F.lit(1)),
    "document": lambda p: F.coalesce(p["pages"], F.lit(1)) * F.lit(256),
}


def visit(part: Column, turn: Column, place: Column) -> Column:
    """struct(body, kind, ref, tokens) of one part: a text part is its escaped text; an attachment is a
    placeholder that names kind, turn and place in the turn, so placeholders are ordered and unique.
    A part of unknown type is kept as its text."""
    kind = F.lower(F.coalesce(part["type"], F.lit("text")))
    name, tokens = F.lit(None).cast("string"), F.lit(0).cast("long")
    for known, size in EXPANSIONS.items():
        name = F.when(kind == known, F.lit(known)).otherwise(name)
        tokens = F.when(kind == known, size(part).cast("long")).otherwise(tokens)
    placeholder = F.concat(F.lit("<|"), name, F.lit(":"), turn.cast("string"), F.lit("."), place.cast("string"), F.lit("|>"))
    body = F.coalesce(placeholder, escape(F.coalesce(part["text"], F.lit(""))))
    return F.struct(body.alias("body"), name.alias("kind"), part["ref"].alias("ref"), tokens.alias("tokens"))


def text_part(text: Column) -> Column:
    """The parts of a turn that is only text (null: empty)."""
    null = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), null.cast("string").alias("ref"), null.cast("int").alias("width"),
            null.cast("int").alias("height"), null.cast("double").alias("seconds"), null.cast("int").alias("pages"),
        )
    )


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", learn: str = "assistant") -> DataFrame:
    """One row per conversation: (conv, segments, attachments, placeholder_tokens).

    ``parts`` is an array of ``PART``. The formatted text is the concatenation of the segments' bodies;
    a segment is under the loss mask (``loss``) when it is the content of a ``learn`` turn. Headers and
    ends of turns are segments of their own outside the mask. ``attachments`` lists kind, reference,
    turn, place and expanded token count in order.

    Turns are ordered by turn, then role and content (nulls first); repeated rows stay. Null roles and
    parts count as empty. A null conversation id is a conversation of its own. Parts are rendered before
    the shuffle; a conversation has to fit in one row, because its text is one training record.
    """
    plain = pick(turns, conv, turn, role, parts).toDF("conv", "turn", "role", "parts")
    place = F.coalesce(F.col("turn").cast("string"), F.lit(""))
    rendered = plain.select(
        "conv", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.transform(F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>")), lambda p, i: visit(p, place, i)).alias("seen"),
    )
    body = F.array_join(F.transform("seen", lambda v: v["body"]), "")
    held = F.transform(
        F.filter("seen", lambda v: v["kind"].isNotNull()),
        lambda v: F.struct(v["kind"].alias("kind"), v["ref"].alias("ref"), v["body"].alias("placeholder"), v["tokens"].alias("tokens")),
    )
    ordered = rendered.select("conv", F.struct("turn", "role", body.alias("body"), held.alias("held")).alias("at"))
    gathered = ordered.groupBy("conv").agg(F.sort_array(F.collect_list("at")).alias("turns"))
    no_loss, loss = F.lit(False), F.lit(True)

    def segments(t: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("body"), no_loss.alias("loss")),
            F.struct(t["body"].alias("body"), F.when(t["role"] == learn, loss).otherwise(no_loss).alias("loss")),
            F.struct(F.lit(END).alias("body"), no_loss.alias("loss")),
        )

    attachments = F.flatten(F.transform("turns", lambda t: t["held"]))
    return gathered.select(
        F.col("conv").alias(conv), F.flatten(F.transform("turns", segments)).alias("segments"), attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("placeholder_tokens"),
    )


def formatted_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["body"]), "")


def parse_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted text; placeholders stay as they are."""
    blocks = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1 << 30)

    def turn(block: Column) -> Column:
        at = F.locate("\n", block)
        inner = F.substr(block, at + 1, F.length(block) - at - F.lit(len(END)))
        return F.struct(unescape_role(F.substr(block, F.lit(1), at - 1)).alias("role"), unescape(inner).alias("text"))

    return F.transform(blocks, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["body"])), "")
