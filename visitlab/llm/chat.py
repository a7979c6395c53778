"""Chat formatting with a grammar round trip, in DataFrame functions only.

    conversation := turn*
    turn         := "<turn " role ">\\n" text "\\n</turn>\\n"     text as it is
                  | "<turn! " role ">\\n" coded "\\n</turn>\\n"   text with escapes

A coded text writes ``\\`` as ``\\b`` and ``<`` as ``\\l``, so it holds no ``<``
and cannot meet a marker; a role is always coded, with ``>`` as ``\\g`` and a line
feed as ``\\n``, and a null role is ``\\0``. The parser is deterministic: cut
behind every end marker, then each piece at its first line feed. It rejects
(null) what the grammar does not give: a piece without an opening marker, a
control string (``<turn``, ``</turn``) inside a text that is not coded, and anything
behind the last end marker.

``render`` first writes every text as it is, parses the result and compares the
recovered turns with the source. In a conversation that does not come back the
texts with control strings are escaped and it is tried again; what still differs
is escaped throughout, which always comes back.

Defined results: turns go by (turn, role, text), nulls first, so ties and
repeated rows keep a fixed order and all of them stay; a null text is empty; null
conv_ids form one conversation; an empty table gives an empty result; extra
columns are ignored. A conversation is one string, so it must fit one row (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: The role whose texts a model learns from.
LEARN = "assistant"
END = "\n</turn>\n"


def code(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def decode(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def code_role(role: Column) -> Column:
    return F.coalesce(F.replace(F.replace(code(role), F.lit(">"), F.lit("\\g")), F.lit("\n"), F.lit("\\n")), F.lit("\\0"))


def decode_role(role: Column) -> Column:
    plain = decode(F.replace(F.replace(role, F.lit("\\g"), F.lit(">")), F.lit("\\n"), F.lit("\n")))
    return F.when(role == "\\0", F.lit(None)).otherwise(plain)


def _segment(turn: Column, escaped: Column) -> Column:
    return F.concat(F.when(escaped, F.lit("<turn! ")).otherwise(F.lit("<turn ")), code_role(turn["role"]), F.lit(">\n"),
                    F.when(escaped, code(turn["text"])).otherwise(turn["text"]), F.lit(END))


def has_control(text: Column) -> Column:
    """Whether a text holds a control string."""
    return text.contains("<turn") | text.contains("</turn")


def parse(formatted: Column) -> Column:
    """The segments of a formatted conversation as (escaped, role, head, body):
    head is the number of code points before the body. Null if the text is not
    of the grammar."""
    # every piece but the last (empty) one lost its end marker
    cut = F.split(formatted, r"\n</turn>\n", -1)
    pieces = F.slice(cut, F.lit(1), F.size(cut) - 1)

    def turn(p: Column) -> Column:
        head = F.substring_index(p, "\n", 1)
        escaped = F.startswith(p, F.lit("<turn! "))
        skip = F.when(escaped, 7).otherwise(6)
        return F.struct(escaped.alias("escaped"), decode_role(F.substr(head, skip + 1, F.length(head) - skip - 1)).alias("role"),
                        (F.length(head) + 1).alias("head"), F.substr(p, F.length(head) + 2).alias("body"))

    def wrong(p: Column) -> Column:
        head = F.substring_index(p, "\n", 1)
        opened = (F.startswith(p, F.lit("<turn! ")) | F.startswith(p, F.lit("<turn "))) & F.endswith(head, F.lit(">")) & (F.length(head) < F.length(p))
        return ~opened | has_control(F.substr(p, F.length(head) + 2))

    return F.when((F.element_at(cut, -1) == "") & ~F.exists(pieces, wrong), F.transform(pieces, turn))


def turns_of(parsed: Column) -> Column:
    """(role, text) of parsed segments, texts decoded."""
    return F.transform(parsed, lambda t: F.struct(t["role"].alias("role"), F.when(t["escaped"], decode(t["body"])).otherwise(t["body"]).alias("text")))


def conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, turns (role, text) in order."""
    turn = F.struct("turn", "role", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return (rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
            .select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")))


def render(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, and loss: for every learned text the segment number and
    the code points [begin, end) of its body within the segment.

    The first try is plain; a conversation that does not come back escapes the
    texts with control strings, and all texts if that fails too."""
    def text_with(escaped) -> Column:
        return F.array_join(F.transform("turns", lambda t: _segment(t, escaped(t))), "")

    tried = conversations(rows).withColumn("formatted", text_with(lambda t: F.lit(False)))
    for rule in (lambda t: has_control(t["text"]), lambda t: F.lit(True)):
        same = turns_of(parse(F.col("formatted"))).eqNullSafe(F.col("turns"))
        tried = tried.withColumn("formatted", F.when(same, F.col("formatted")).otherwise(text_with(rule)))
    loss = F.transform(parse(F.col("formatted")), lambda t, i: F.struct(
        i.cast("int").alias("segment"), t["head"].alias("begin"), (t["head"] + F.length(t["body"])).alias("end"), t["role"].alias("role")))
    spans = F.transform(F.filter(loss, lambda s: s["role"] == LEARN), lambda s: F.struct(
s["segment"].alias("segment"), s["begin"].alias("begin"), s["end"].alias("end")))
    return tried.select("conv_id", "formatted", spans.alias("loss"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """``render`` written to the shared folder and read back."""
    return materialize(render(rows), "formatted")


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted output holds: conv_id, n_turns, turns_sha256 (role, line
    feed, text, line feed per turn), loss_chars and loss_sha256 (the texts under
    the loss mask, decoded), formatted_chars."""
    pieces = F.split(F.col("formatted"), r"\n</turn>\n", -1)

    def learned(s: Column) -> Column:
        piece = F.get(F.col("pieces"), s["segment"])
        cut = F.substr(piece, s["begin"] + 1, s["end"] - s["begin"])
        return F.when(F.startswith(piece, F.lit("<turn! ")), decode(cut)).otherwise(cut)

    read = formatted.withColumn("pieces", pieces).select(
        "conv_id", "formatted", turns_of(parse(F.col("formatted"))).alias("turns"),
        F.array_join(F.transform("loss", learned), "").alias("learned"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
