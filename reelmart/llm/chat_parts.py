"""Chat formatting of typed content parts, in SQL functions.

A turn is a list of parts: text, image, audio or document. A visitor, one expression per type, flattens them into ordered
text: text with its control strings escaped, and for an attachment a placeholder, repeated for every token that the
attachment expands to. The references of the attachments are recorded in the same order with their token counts.

    <|im_start|>role<|im_sep|>parts ...<|im_end|>

Control strings begin with `<` or `[`. Inside a text, one with any number of backslashes after its first sign gets one
more, and reading takes one away, so what a text says is never a control string and every text can be read back.
Texts that stand side by side, with nothing or attachments of no tokens between them, are escaped as one text, so a
control string cut across parts is escaped, too.

Defined cases: a null text is empty, a null role is the empty role, a null list of parts is a turn without text, an
unknown type of part is a placeholder of that type; turns of equal number stand by role and then text (null first);
repeated rows are separate turns; null conversation ids are one conversation; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What the template writes, and control strings of other templates that texts must not carry either.
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
FOREIGN = ("<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|eot_id|>")
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
OTHER = "<|attachment|>"

_PARTS = "array<struct<type: string, text: string, ref: string, tokens: long>>"
_CONTROLS = (START, SEPARATOR, END, *FOREIGN, *PLACEHOLDERS.values(), OTHER)
_SIGNS = "".join(sorted({c[0] for c in _CONTROLS}))


def _literal(text: str) -> str:
    return "".join("\\" + c if c in r"\^$.|?*+()[]{}<>/" else c for c in text)


_BODIES = "|".join(_literal(c[1:]) for c in sorted(_CONTROLS, key=lambda c: (-len(c), c)))
_ESCAPE = rf"([{_literal(_SIGNS)}])(\\*)({_BODIES})"
_UNESCAPE = rf"([{_literal(_SIGNS)}])\\(\\*)({_BODIES})"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), F.lit(_ESCAPE), F.lit(r"$1\\$2$3"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_UNESCAPE), F.lit("$1$2$3"))


def _placeholder(kind: Column) -> Column:
    return reduce(lambda out, x: out.when(kind == x[0], F.lit(x[1])), PLACEHOLDERS.items(), F.when(F.lit(False), "")).otherwise(OTHER)


def visit(part: Column) -> Column:
    """A part as text; part: struct(type, text, ref, tokens)."""
    tokens = F.greatest(F.coalesce(part["tokens"], F.lit(1)), F.lit(0)).cast("int")
    return F.when(part["type"] == "text", escaped(part["text"])).otherwise(F.repeat(_placeholder(part["type"]), tokens))


def is_text(part: Column) -> Column:
    return F.coalesce(part["type"] == "text", F.lit(False))


def runs(parts: Column) -> Column:
    """The parts that show in the output, each run of adjacent texts as one text."""
    shown = F.filter(parts, lambda p: is_text(p) | (F.coalesce(p["tokens"], F.lit(1)) > 0))

    def part(like: Column, text: Column) -> Column:
        return F.array(F.struct(like["type"].alias("type"), text.alias("text"), like["ref"].alias("ref"), like["tokens"].alias("tokens")))

    def text(p: Column) -> Column:
        return F.when(is_text(p), F.coalesce(p["text"], F.lit("")))

    def step(out: Column, p: Column) -> Column:
        last = F.get(out, F.size(out) - 1)
        before = F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0)))
        joined = F.concat(before, part(last, F.concat(last["text"], text(p))))
        return F.when(is_text(p) & is_text(last), joined).otherwise(F.concat(out, part(p, text(p))))

    return F.aggregate(shown, F.expr(f"cast(array() as {_PARTS})"), step)  # the parts of one turn are few


def formatted(turns: DataFrame, learned: str = "assistant") -> DataFrame:
    """conv_id, formatted, spans (start, length of what is learned, in code points), attachments (turn, type, ref, tokens).

    turns: conv_id, turn, role, parts. A span is a run of text parts of a turn whose role is ``learned``. All turns of a
    conversation are one string in the end, so a conversation must fit a row.
    """
    role = F.coalesce("role", F.lit(""))
    parts = F.coalesce(F.col("parts").cast(_PARTS), F.expr(f"cast(array() as {_PARTS})"))
    rows = turns.select("conv_id", "turn", role.alias("role"), parts.alias("every")).withColumn("parts", runs(F.col("every")))
    head = F.concat(F.lit(START), escaped(F.col("role")), F.lit(SEPARATOR))
    rows = rows.withColumn("head", head).withColumn("pieces", F.transform("parts", visit))
    rows = rows.withColumn("said", F.concat("head", F.array_join("pieces", ""), F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "said")
    rows = rows.withColumn("number", F.row_number().over(order))
    rows = rows.withColumn("place", F.coalesce(F.sum(F.char_length("said").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # a running length over the pieces; the parts of one turn are few
    ends = F.aggregate(
        "pieces",
        F.array(F.col("place") + F.char_length("head")),
        lambda out, piece: F.concat(out, F.array(F.element_at(out, -1) + F.char_length(piece))),
    )
    rows = rows.withColumn("ends", ends)
    spans = F.transform("parts", lambda p, i: F.struct(F.get("ends", i).alias("start"), (F.get("ends", i + 1) - F.get("ends", i)).alias("length"), is_text(p).alias("text")))
    spans = F.transform(F.filter(spans, lambda s: s["text"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
    rows = rows.withColumn("spans", F.when(F.col("role") == learned, spans).otherwise(F.filter(spans, lambda s: F.lit(False))))
    attached = F.transform(F.filter("every", lambda p: ~is_text(p)), lambda p: F.struct("turn", p["type"].alias("type"), p["ref"].alias("ref"), F.coalesce(p["tokens"], F.lit(1)).alias("tokens")))
    by_number = F.sort_array(F.collect_list(F.struct("number", "said", "spans", attached.alias("attached"))))
    whole = rows.groupBy("conv_id").agg(by_number.alias("turns"))
    return whole.select(
        "conv_id",
        F.array_join("turns.said", "").alias("formatted"),
        F.flatten("turns.spans").alias("spans"),
        F.flatten("turns.attached").alias("attachments"),
    )


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of struct(role, text); placeholders stay in the text."""
    marked = F.filter(F.split(formatted, _literal(START)), lambda x: x != "")

    def turn(said: Column) -> Column:
        halves = F.split(said, _literal(SEPARATOR))
        text = F.get(halves, F.lit(1))
        return F.struct(unescaped(F.get(halves, F.lit(0))).alias("role"), unescaped(F.left(text, F.char_length(text) - len(END))).alias("text"))

    return F.transform(marked, turn)


def parsed_parts(formatted: Column) -> Column:
    """The same with parts instead of a text: array of struct(role, parts of (type, text)).

    What a text says stays text; a placeholder is a part of its type without text, of type attachment if that is unknown.
    """
    kinds = [*PLACEHOLDERS.items(), ("attachment", OTHER)]
    any_ = "|".join(_literal(x) for _, x in kinds)
    marked = F.filter(F.split(formatted, _literal(START)), lambda x: x != "")

    def part(kind: Column, text: Column) -> Column:
        return F.struct(kind.alias("type"), text.alias("text"))

    def turn(said: Column) -> Column:
        halves = F.split(said, _literal(SEPARATOR))
        body = F.left(F.get(halves, F.lit(1)), F.char_length(F.get(halves, F.lit(1))) - len(END))
        texts = F.transform(F.split(body, any_), lambda t: part(F.lit("text"), unescaped(t)))
        found = F.transform(F.regexp_extract_all(body, F.lit(any_), F.lit(0)), lambda x: part(reduce(lambda out, k: out.when(x == k[1], F.lit(k[0])), kinds, F.when(F.lit(False), "")), F.lit(None).cast("string")))
        mixed = F.flatten(F.transform(F.arrays_zip(texts.alias("t"), found.alias("f")), lambda z: F.array(z["t"], z["f"])))
        return F.struct(unescaped(F.get(halves, F.lit(0))).alias("role"), F.filter(mixed, lambda p: p["type"].isNotNull() & ~F.coalesce(p["text"] == "", F.lit(False))).alias("parts"))

    return F.transform(marked, turn)


def under_mask(formatted: Column, spans: Column) -> Column:
    """The texts under the spans, unescaped: an array in order."""
    wide = F.encode(formatted, "UTF-32")  # four bytes a code point, so a span is found without counting from the start
    cut = F.transform(F.array(wide), lambda w: F.transform(spans, lambda s: unescaped(F.decode(F.substring(w, (s["start"] * 4 + 1).cast("int"), (s["length"] * 4).cast("int")), "UTF-32"))))
    return F.element_at(cut, 1)


def as_parts(conversations: DataFrame) -> DataFrame:
    """Rows of conv_id, turn, role, text as turns of one text part."""
    part = F.struct(F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("tokens"))
    return conversations.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all from what was formatted."""
    rows = chats.withColumn("turns", parsed(F.col("formatted"))).withColumn("learned", under_mask(F.col("formatted"), F.col("spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("learned", "")
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
