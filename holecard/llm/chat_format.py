"""Chat formatting with typed content parts.

Method: a visitor walks the parts of every message in order.  Text is escaped;
image, audio and document parts become numbered placeholders, and an attachment
reference is recorded with the number of tokens that the placeholder expands
to.  DataFrame functions only.

Template: ``<turn>ROLE<says>PARTS</turn>\\n``.  In roles and texts ``&`` is
written ``&amp;`` and ``<`` is written ``&lt;``, so a ``<`` in the output always
begins a mark, and the inputs can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: marks of the template ---
OPEN, SAYS, CLOSE = "<turn>", "<says>", "</turn>\n"
ASSISTANT = "assistant"
#: The type of content parts that `format_chats` takes.
PARTS = ("array<struct<kind:string, text:string, uri:string, "
         "width:int, height:int, seconds:double, pages:int>>")
#: Expansion: tokens of an image tile of so many pixels a side, of a second of
#: sound, of a document's page.
TILE, SECOND_TOKENS, PAGE_TOKENS = 14, 25, 560


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def text_part(text: Column) -> Column:
    """Content of one text part."""
    null = F.lit(None)
    part = F.struct(F.lit("text").alias("kind"), text.alias("text"), null.cast("string").alias("uri"),
                    null.cast("int").alias("width"), null.cast("int").alias("height"),
                    null.cast("double").alias("seconds"), null.cast("int").alias("pages"))
    return F.array(part)


def _attached(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) != "text"


def _expands_to(part: Column) -> Column:
    """Tokens of a part: words of a text, the expansion of an attachment."""
    zero = F.lit(0)
    tiles = lambda c: F.ceil(F.coalesce(part[c], zero) / TILE)
    return F.coalesce(
        F.when(part["kind"] == "image", tiles("width") * tiles("height"))
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * SECOND_TOKENS))
        .when(part["kind"] == "document", F.coalesce(part["pages"], zero) * PAGE_TOKENS)
        .when(_attached(part), zero)
        .otherwise(F.size(F.regexp_extract_all(F.coalesce(part["text"], F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), 0)))
        .cast("long"), F.lit(0).cast("long"))


def format_chats(messages: DataFrame) -> DataFrame:
    """One row per conversation of ``messages (conv_id, turn, role, content)``:
    ``(conv_id, n_turns, formatted, turns, attachments, expanded_tokens)``.

    ``content`` is an array of parts (type ``PARTS``).  ``turns`` holds a struct
    ``(offset, chars, loss_start, loss_end)`` in order: where the turn begins in
    ``formatted``, its code points, and the part of it under the loss mask,
    from the turn's begin (both 0 for roles other than assistant; the mask
    covers the content of an assistant's turn).  ``attachments`` are structs
    ``(number, kind, uri, tokens)`` in order; number n is written ``<kind:n>``.
    ``expanded_tokens`` counts words of texts and expansions of attachments.

    Rows go by turn, nulls first, then by role, the parts' texts and the parts;
    repeated rows each are a turn.  A null role or text is empty, null parts and contents vanish,
    a part without a kind is text.  Kinds other than the four are attachments
    without tokens.  Rows with a null conv_id are one conversation.  A
    conversation is one row of the result, so it must fit in one.
    """
    rows = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                           F.filter(F.coalesce("content", F.array().cast(PARTS)), lambda p: p.isNotNull()).alias("parts"))
    rows = rows.withColumn("n_attached", F.size(F.filter("parts", _attached)))
    rows = rows.withColumn("said", F.array_join(F.transform("parts", lambda p: F.coalesce(p["text"], F.lit(""))), ""))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "said", "parts")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("place", F.row_number().over(order)) \
        .withColumn("numbered", F.coalesce(F.sum("n_attached").over(earlier), F.lit(0)))
    number = lambda i: F.col("numbered") + F.size(F.filter(F.slice("parts", 1, i + 1), _attached))
    visited = F.transform("parts", lambda p, i: F.when(
        _attached(p), F.concat(F.lit("<"), escape(p["kind"]), F.lit(":"), number(i).cast("string"), F.lit(">")))
        .otherwise(escape(F.coalesce(p["text"], F.lit("")))))
    found = F.filter(F.transform("parts", lambda p, i: F.when(_attached(p), F.struct(
        number(i).cast("long").alias("number"), p["kind"].alias("kind"), p["uri"].alias("uri"),
        _expands_to(p).alias("tokens")))), lambda a: a.isNotNull())
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(SAYS))
    rows = rows.withColumn("body", F.array_join(visited, "")).withColumn("head", head)
    rows = rows.select(
        "conv_id", "turn", "role", "parts", "place",
        F.concat("head", "body", F.lit(CLOSE)).alias("piece"),
        F.when(F.col("role") == ASSISTANT, F.length("head")).otherwise(0).cast("long").alias("loss_start"),
        F.when(F.col("role") == ASSISTANT, F.length("head") + F.length("body")).otherwise(0).cast("long").alias("loss_end"),
        found.alias("found"),
        F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + _expands_to(p)).alias("tokens"))
    rows = rows.withColumn("chars", F.length("piece").cast("long"))
    until = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("offset", F.coalesce(F.sum("chars").over(until), F.lit(0).cast("long")))
    one = F.struct("place", "piece", "offset", "chars", "loss_start", "loss_end", "found", "tokens")
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("all"))
    return chats.select(
        "conv_id", F.size("all").cast("long").alias("n_turns"),
        F.array_join(F.col("all.piece"), "").alias("formatted"),
        F.transform("all", lambda t: F.struct(t["offset"].alias("offset"), t["chars"].alias("chars"),
                                              t["loss_start"].alias("loss_start"), t["loss_end"].alias("loss_end"))).alias("turns"),
        F.flatten(F.col("all.found")).alias("attachments"),
        F.aggregate("all", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("expanded_tokens"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as written, marks included."""
    return F.transform(F.filter(F.split(formatted, CLOSE), lambda p: p != ""), lambda p: F.concat(p, F.lit(CLOSE)))


def read_role(piece: Column) -> Column:
    return unescape(F.substring_index(F.substr(piece, F.lit(len(OPEN) + 1)), SAYS, 1))


def read_text(piece: Column) -> Column:
    """The content of a turn of text parts."""
    body = F.substring_index(piece, SAYS, -1)
    return unescape(F.substr(body, F.lit(1), F.length(body) - len(CLOSE)))


def read_loss(piece: Column, turn: Column) -> Column:
    """What the loss mask covers of a turn, unescaped."""
    return unescape(F.substr(piece, turn["loss_start"].cast("int") + 1,
                             (turn["loss_end"] - turn["loss_start"]).cast("int")))
