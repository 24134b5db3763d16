"""Chat formatting with typed content parts, in DataFrame expressions only.

A message holds parts of four kinds: text, image, audio and document. A visitor flattens
them in order: text becomes escaped text, any other part a placeholder that no text can
spell, with an attachment record (turn, place, kind, reference, expanded token count).
Turns stand between marks; a list of spans says which characters train the model.

Escaping is reversible: ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``, so a text never
holds ``<|``, with which every control string begins. A text behind another
part gets a ``\\`` before a ``|`` it starts with, so none arises where two parts meet either.

Results: null text is empty text, a null role is the empty role, a null or empty part list
gives an empty turn. Turns are ordered by turn number, then role, then parts, so repeated
rows are repeated turns in a fixed order. A null conversation id is one conversation.
An empty table gives no rows; other columns are ignored. A text may have any length: each is
read a fixed number of times, and spans are cut from their own turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PLACEHOLDERS = ("image", "audio", "document")
TRAINED_ROLE = "assistant"

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def text_part(text: Column) -> Column:
    return F.struct(F.lit("text").alias("kind"), text.cast("string").alias("text"), *[F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))])


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    """One line without control strings."""
    for plain, coded in (("%", "%25"), ("\n", "%0A"), ("<|", "%3C|")):
        role = F.replace(role, F.lit(plain), F.lit(coded))
    return role


def unescape_role(role: Column) -> Column:
    for plain, coded in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(coded), F.lit(plain))
    return role


def expanded_tokens(part: Column, patch: int = 14, per_second: int = 25, per_page: int = 512) -> Column:
    """Tokens an attachment stands for: image patches, audio frames, document pages."""
    tiles = lambda n: F.ceil(F.coalesce(n, F.lit(0)) / patch)
    return (
        F.when(part["kind"] == "image", tiles(part["width"]) * tiles(part["height"]))
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * per_second))
        .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)).cast("long") * per_page)
        .otherwise(F.lit(0))
        .cast("long")
    )


def visit(part: Column, place: Column) -> Column:
    """What one part contributes: its string, whether it is text, its tokens, its reference."""
    known = part["kind"].isin(*PLACEHOLDERS)
    text = escape(F.coalesce(part["text"], F.lit("")))
    joint = F.when((place > 0) & F.startswith(text, F.lit("|")), F.concat(F.lit("\\"), text)).otherwise(text)
    shown = F.when(known, F.concat(F.lit("<|"), part["kind"], F.lit("|>"))).otherwise(joint)
    return F.struct(
        shown.alias("shown"),
        F.coalesce(~known, F.lit(True)).alias("is_text"),
        part["kind"].alias("kind"),
        part["ref"].alias("ref"),
        expanded_tokens(part).alias("tokens"),
    )


def format_chat(messages: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """One row per conversation from (conv_id, turn, role, parts).

    Columns: conv_id, formatted, loss_spans (start from 0 and length, in code points, with
    the turn's number from 1 and the start within it), attachments, expanded_tokens. A conversation is one string, so its own messages, and no
    other rows, meet in one place; offsets come from a running sum, linear in its turns.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    head = F.concat(F.lit(START), escape_role(F.col("_role")), F.lit("\n"))
    no_parts = F.array().cast(f"array<{PART}>")
    turns = (
        messages.select(
            "conv_id", "turn", role.alias("_role"), F.coalesce(F.col("parts"), no_parts).alias("_parts")
        )
        .withColumn("_pieces", F.transform("_parts", visit))
        .withColumn("_body", F.array_join(F.col("_pieces.shown"), ""))
        .withColumn("_head", head)
        .withColumn("_shown", F.concat("_head", "_body", F.lit(END + "\n")))
    )
    # Where a turn starts: the lengths of all turns before it.
    earlier = (
        Window.partitionBy("conv_id")
        .orderBy("turn", "_role", "_parts")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.coalesce(F.sum(F.length("_shown").cast("long")).over(earlier), F.lit(0).cast("long"))
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "_role", "_parts"))
    # Where a part starts within its turn: the lengths of the parts before it.
    part_start = lambda i: F.aggregate(
        F.slice("_pieces", F.lit(1), i),
        F.length("_head").cast("long"),
        lambda n, p: n + F.length(p["shown"]).cast("long"),
    )
    laid = turns.withColumn("_start", start).withColumn("_number", number).withColumn(
        "_placed",
        F.transform(
            "_pieces",
            lambda p, i: F.struct(
                F.col("turn").cast("long").alias("turn"),
                (F.col("_start") + part_start(i)).alias("start"),
                part_start(i).alias("at"),
                F.length(p["shown"]).cast("long").alias("length"),
                p["is_text"].alias("is_text"),
                p["kind"].alias("kind"),
                p["ref"].alias("ref"),
                p["tokens"].alias("tokens"),
            ),
        ),
    )
    trained = F.filter("_placed", lambda p: p["is_text"] & (F.col("_role") == trained_role))
    spans = F.transform(trained, lambda p: F.struct("_number", *[p[c].alias(c) for c in ("start", "length", "at")]))
    attached = F.transform(
        F.filter("_placed", lambda p: ~p["is_text"]),
        lambda p: F.struct(*[p[c].alias(c) for c in ("start", "turn", "kind", "ref", "tokens")]),
    )
    whole = laid.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("_number", "_shown"))).alias("_turns"),
        F.flatten(F.sort_array(F.collect_list(spans))).alias("_spans"),
        F.sort_array(F.flatten(F.collect_list(attached))).alias("attachments"),
        F.sum(F.aggregate("_pieces", F.lit(0).cast("long"), lambda n, p: n + p["tokens"])).alias("expanded_tokens"),
    )
    return whole.select(
        "conv_id",
        F.array_join(F.col("_turns._shown"), "").alias("formatted"),
        F.transform(
            "_spans", lambda s: F.struct(*[s[c].alias(n) for c, n in (("start", "start"), ("length", "length"), ("_number", "number"), ("at", "at"))])
        ).alias("loss_spans"),
        "attachments",
        "expanded_tokens",
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) a formatted conversation spells, unescaped.

    Placeholders come back as they are written.
    """
    # Every turn starts with the start mark, so the first piece of the split is empty.
    blocks = F.slice(F.split(formatted, "<\\|im_start\\|>", -1), 2, 1 << 30)
    turn = lambda b: F.struct(
        unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
        unescape(
            F.substring(
                b,
                F.length(F.substring_index(b, "\n", 1)) + 2,
                F.length(b) - F.length(F.substring_index(b, "\n", 1)) - 1 - len(END + "\n"),
            )
        ).alias("text"),
    )
    return F.transform(blocks, turn)


def trained_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between.

    Each span is cut from its own turn, so the work is linear in the conversation.
    """
    turns = F.split(formatted, "<\\|im_start\\|>", -1)

    def cut(s: Column) -> Column:
        start = (s["at"] - len(START) + 1).cast("int")
        return unescape(F.substring(F.get(turns, s["number"]), start, s["length"].cast("int")))

    return F.array_join(F.transform(spans, cut), "")
