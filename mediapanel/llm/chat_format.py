"""Chat formatting in SQL functions alone.

The turns of a conversation are collected as structs and sorted; neighbours of
one role become one block, whose texts are joined by ``NEXT``; blocks are
wrapped in the marks of their role and concatenated behind ``BEGIN``:

    <s>[SYS]text[/SYS][INST]text[/INST][ASST]text[NEXT]text</s>

Any other role is spelled out: ``[ROLE]role[TEXT]text[/TEXT]``. The loss mask
is a list of runs (chars, loss) that covers the formatted text in order, one
run per mark or text; the texts of ``assistant`` turns are under the loss,
marks never are.

Escaping: a mark inside a text or role gets a backslash behind its first
character, and one that has backslashes there already gets one more, so no text
holds a mark and taking one backslash away restores it (``unescaped``). Every
mark starts with ``<`` or ``[`` and has neither further on, so marks cannot
overlap, nor arise where two pieces meet. Texts are escaped before the shuffle.

Null texts and roles count as empty, a null turn sorts first, rows with a null
conv_id are one conversation. Rows that tie on the turn are sorted by role,
then by escaped text; repeated rows are kept as turns. An empty table gives no
rows. All steps are linear in the length of a conversation, which is one value
of the result and therefore has to fit in one (2 GB). Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, NEXT = "<s>", "[NEXT]"
ROLES = {"user": ("[INST]", "[/INST]"), "assistant": ("[ASST]", "</s>"), "system": ("[SYS]", "[/SYS]")}
OTHER_OPEN, OTHER_TEXT, OTHER_CLOSE = "[ROLE]", "[TEXT]", "[/TEXT]"
LOSS_ROLE = "assistant"

# The marks behind their first character.
ANGLE, SQUARE = r"/?s>", r"(?:/?INST|ASST|/?SYS|ROLE|/?TEXT|NEXT)\]"
MARK = rf"(?:<{ANGLE}|\[{SQUARE})"
BLOCK = (r"(?s)\[INST\].*?\[/INST\]|\[ASST\].*?</s>|\[SYS\].*?\[/SYS\]|"
         r"\[ROLE\].*?\[/TEXT\]")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"(<(?=\\*+{ANGLE})|\[(?=\\*+{SQUARE}))", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<=<)\\(?=\\*+{ANGLE})|(?<=\[)\\(?=\\*+{SQUARE})", "")


def _piece(text: Column | str, loss: Column | bool = False) -> Column:
    return F.struct((F.lit(text) if isinstance(text, str) else text).alias("text"),
                    (loss if isinstance(loss, Column) else F.lit(loss)).alias("loss"))


def _by_role(role: Column, named, other: Column) -> Column:
    out = None
    for name in ROLES:
        out = (F if out is None else out).when(role == name, named(*ROLES[name]))
    return out.otherwise(other)


def _pieces(block: Column) -> Column:
    """Marks and texts of one block (role, texts), in order."""
    role, texts = block["role"], block["texts"]
    opening = _by_role(role, lambda o, c: F.array(_piece(o)),
                       F.array(_piece(OTHER_OPEN), _piece(role), _piece(OTHER_TEXT)))
    closing = _by_role(role, lambda o, c: F.array(_piece(c)), F.array(_piece(OTHER_CLOSE)))
    said = F.transform(texts, lambda t, i: F.when(i == 0, F.array(_piece(t, role == LOSS_ROLE)))
                       .otherwise(F.array(_piece(NEXT), _piece(t, role == LOSS_ROLE))))
    return F.concat(opening, F.flatten(said), closing)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, mask) of each conversation; ``mask`` is
    array<struct<chars int, loss boolean>>. Input (conv_id, turn, role, text)."""
    rows = conversations.select(
        "conv_id", F.struct("turn", *[escaped(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c)
                                      for c in ("role", "text")]).alias("turn"))
    sorted_ = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    turns, heads = F.col("turns"), F.col("heads")
    first = F.filter(F.sequence(F.lit(0), F.size(turns) - 1),
                     lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))
    merged = F.transform(heads, lambda at, k: F.struct(
        F.get(turns, at)["role"].alias("role"),
        F.slice(turns, at + 1, F.coalesce(F.get(heads, k + 1), F.size(turns)) - at)["text"].alias("texts")))
    pieces = F.concat(F.array(_piece(BEGIN)), F.flatten(F.transform(merged, _pieces)))
    return (sorted_.withColumn("heads", first).select("conv_id", pieces.alias("pieces")).select(
        "conv_id", F.array_join(F.col("pieces")["text"], "").alias("formatted"),
        F.filter(F.transform("pieces", lambda p: F.struct(F.char_length(p["text"]).alias("chars"),
                                                          p["loss"].alias("loss"))),
                 lambda m: m["chars"] > 0).alias("mask")))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text was made of."""
    def block(b: Column) -> Column:
        role = _by_role_of(b)
        inner = F.when(b.startswith(OTHER_OPEN), F.substring_index(b, OTHER_TEXT, -1)).otherwise(b)
        inner = F.regexp_replace(inner, r"\A\[(?:INST|ASST|SYS)\]|(?:\[/(?:INST|SYS|TEXT)\]|</s>)\z", "")
        return F.transform(F.split(inner, r"\[NEXT\]", -1),
                           lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    def _by_role_of(b: Column) -> Column:
        out = None
        for name, (opening, _) in ROLES.items():
            out = (F if out is None else out).when(b.startswith(opening), F.lit(name))
        named = F.substring_index(F.substring(b, len(OTHER_OPEN) + 1, 2 ** 31 - 1), OTHER_TEXT, 1)
        return out.otherwise(unescaped(named))

    return F.flatten(F.transform(F.regexp_extract_all(formatted, F.lit(BLOCK), F.lit(0)), block))


def loss_texts(formatted: Column, mask: Column) -> Column:
    """The stretches of the formatted text under the loss mask, as they stand
    there. The text is cut at its marks, which is where the runs end; a run
    that is not as long as its stretch is an error."""
    cut = F.split(formatted, rf"(?<=<s>|</s>|\](?<=\[{SQUARE}))|(?={MARK})", -1)
    runs = F.arrays_zip(F.filter(cut, lambda s: s != "").alias("stretch"), mask.alias("run"))
    held = F.filter(runs, lambda r: F.when(
        F.char_length(r["stretch"]).eqNullSafe(r["run"]["chars"]), r["run"]["loss"])
        .otherwise(F.raise_error(F.lit("loss mask and text differ")).cast("boolean")))
    return F.transform(held, lambda r: r["stretch"])


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from ``format_conversations``' output."""
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = formatted.select("conv_id", F.char_length("formatted").cast("long").alias("formatted_chars"),
                            read_turns(F.col("formatted")).alias("turns"),
                            F.array_join(F.transform(loss_texts(F.col("formatted"), F.col("mask")), unescaped), "").alias("loss"))
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
