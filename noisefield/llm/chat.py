"""Chat formatting with typed content parts.

A turn's content is a list of parts (text, image, audio, document). They are flattened in order: text is escaped,
every other part becomes a placeholder, its reference and expanded token count recorded in order. Turns become
`<|turn|>role<|body|>content</s>`. A control string inside a text is broken by a backslash after its first
character and backslashes are doubled, so no control string survives in a text and the change can be undone. Neighbouring
text parts are joined before they are escaped, so that none forms across a seam either; a text next to a placeholder cannot
form one, since no control string holds another one's beginning or end. The
loss mask is a list of spans over the assistant's contents. Only DataFrame operations are used.

Edge cases: a null role or text reads as empty; null parts or an empty list give an empty content. A part of an unknown type
(or none) that has a text is a text; one without a text is an attachment of type `unknown` with its own placeholder, its
reference, and no tokens. Turns are ordered by turn (null first), then role and content, and repeated rows stay; a
null conv_id is a conversation; an empty table gives no rows; extra columns play no part. A conversation is one output row, so it
is gathered whole, very long texts too: its size is bounded by what a row can hold (2 GB), not by this operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "</s>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>", "unknown": "<|unknown|>"}
#: Strings that a text may not contain as they stand.
CONTROLS = [TURN, BODY, END, *PLACEHOLDERS.values(), "<s>", "[INST]", "[/INST]"]
#: Tokens of one unit: an image's tile, a second of audio, a document's page.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 600, "unknown": 0}
CHARS_PER_TOKEN = 4
PARTS = "array<struct<type:string,text:string,ref:string,units:double>>"


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("double").alias("units"))).cast(PARTS)


def _by_type(kind: Column, choices: dict[str, object], otherwise: Column) -> Column:
    out = otherwise
    for name, value in choices.items():
        out = F.when(kind == name, F.lit(value)).otherwise(out)
    return out


def visit(parts: Column) -> Column:
    """The parts in order as structs (kind, text, ref, tokens): kind is text or a placeholder's name."""

    def one(p: Column) -> Column:
        kind = F.when(p["type"].isin(*(k for k in PLACEHOLDERS if k != "unknown")), p["type"]).when(p["text"].isNotNull() | F.coalesce(p["type"] == "text", F.lit(False)), "text").otherwise("unknown")
        units = F.coalesce(p["units"], F.lit(1.0))
        return F.struct(kind.alias("kind"), F.when(kind == "text", F.coalesce(p["text"], F.lit(""))).alias("text"), p["ref"].alias("ref"), F.ceil(units * _by_type(kind, UNIT_TOKENS, F.lit(0))).cast("long").alias("tokens"))

    return F.transform(F.coalesce(parts, F.array().cast(PARTS)), one)


def flatten(seen: Column) -> Column:
    """Visited parts as one string: escaped texts and placeholders. Texts between two placeholders are one text."""
    # a part begins a new piece if it or the one before is a placeholder
    state = "struct<done:string,open:string>"
    begin = F.struct(F.lit("").alias("done"), F.lit("").alias("open")).cast(state)
    text = lambda p: p["kind"] == "text"
    step = lambda s, p: F.struct(F.when(text(p), s["done"]).otherwise(F.concat(s["done"], escape(s["open"]), _by_type(p["kind"], PLACEHOLDERS, F.lit("")))).alias("done"), F.when(text(p), F.concat(s["open"], p["text"])).otherwise("").alias("open")).cast(state)
    return F.aggregate(seen, begin, step, lambda s: F.concat(s["done"], escape(s["open"])))


def attachments(seen: Column) -> Column:
    """Type, reference and expanded tokens of the visited parts that are not text, in order."""
    return F.transform(F.filter(seen, lambda p: p["kind"] != "text"), lambda p: F.struct(p["kind"].alias("type"), p["ref"].alias("ref"), p["tokens"].alias("tokens")))


def text_tokens(seen: Column) -> Column:
    chars = F.aggregate(seen, F.lit(0).cast("long"), lambda n, p: n + F.coalesce(F.length(p["text"]), F.lit(0)))
    return F.ceil(chars / CHARS_PER_TOKEN).cast("long")


def format_chats(turns: DataFrame) -> DataFrame:
    """From conv_id, turn, role and parts: one row a conversation with formatted, loss_spans, attachments and expanded_tokens."""
    role = F.coalesce(F.col("role"), F.lit(""))
    t = turns.select("conv_id", "turn", role.alias("role"), visit(F.col("parts")).alias("seen"))
    t = t.select("conv_id", "turn", "role", flatten(F.col("seen")).alias("content"), attachments(F.col("seen")).alias("files"), text_tokens(F.col("seen")).alias("text_tokens"))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY))
    t = t.select("conv_id", "turn", "role", "content", F.length(head).alias("head_chars"), F.concat(head, "content", F.lit(END)).alias("rendered"), "files", "text_tokens")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "content").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("start", F.coalesce(F.sum(F.length("rendered")).over(order), F.lit(0)) + F.col("head_chars"))
    t = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "content", "start", "rendered", "files", "text_tokens"))).alias("turns"))
    mine = F.filter("turns", lambda x: x["role"] == "assistant")
    files = F.flatten(F.transform("turns", lambda x: x["files"]))
    tokens = F.aggregate("turns", F.lit(0).cast("long"), lambda n, x: n + x["text_tokens"]) + F.aggregate(files, F.lit(0).cast("long"), lambda n, f: n + f["tokens"])
    return t.select(
        "conv_id",
        F.concat_ws("", F.transform("turns", lambda x: x["rendered"])).alias("formatted"),
        F.transform(mine, lambda x: F.struct(x["start"].alias("start"), F.length(x["content"]).alias("chars"))).alias("loss_spans"),
        F.transform(files, lambda f, i: F.struct((i + 1).alias("place"), f["type"].alias("type"), f["ref"].alias("ref"), f["tokens"].alias("tokens"))).alias("attachments"),
        tokens.alias("expanded_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """Role and content of each turn, parsed from the formatted string; contents are unescaped."""
    cut = F.split(formatted, r"<\|turn\|>")
    cut = F.slice(cut, F.lit(2), F.greatest(F.size(cut) - 1, F.lit(0)))

    def one(piece: Column) -> Column:
        role = F.substring_index(piece, BODY, 1)
        content = F.substring(piece, F.length(role) + len(BODY) + 1, F.length(piece) - F.length(role) - len(BODY) - len(END))
        return F.struct(unescape(role).alias("role"), unescape(content).alias("text"))

    return F.transform(cut, one)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.concat_ws("", F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["chars"]))))
