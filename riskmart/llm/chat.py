"""Chat formatting with a grammar round trip, in DataFrame functions only.

A formatted conversation is a run of turns, each `open text close`. The parser cuts the output
before every control string, so it is deterministic: two pieces are a turn, and a control string
inside a text gives a piece too many. Texts are rendered as they are first; where the parser does
not give back the source turns, control strings in the texts are escaped, until it does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import let

#: role: (open, close). Any other role is written as `<turn:role> text </turn>`.
MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
}
OTHER = ("<turn:", "</turn>")
LEARNT = "assistant"
#: The control strings, each split where an escape goes in.
_HEADS = r"(\[/?|</?|<</?)"
_TAILS = r"(INST\]|SYS>>|s>|turn(?::|>))"
_CONTROL = r"(?:\[/?INST\]|<</?SYS>>|</?s>|<turn:|</turn>)"
#: Escaping doubles as it nests: one backslash more between head and tail.
_PLAIN = rf"{_HEADS}(\\*){_TAILS}"
_ESCAPED = rf"{_HEADS}\\(\\*){_TAILS}"


def escape(text: Column) -> Column:
    """Puts one more backslash into every control string, escaped or not."""
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """Takes one backslash out of every escaped control string: undoes `escape`."""
    return F.regexp_replace(text, _ESCAPED, r"$1$2$3")


def _mark(role: Column, side: int) -> Column:
    known = F.when(F.lit(False), F.lit(""))
    for name, marks in MARKS.items():
        known = known.when(role == name, F.lit(marks[side]))
    return known.otherwise(F.concat(F.lit(OTHER[0]), F.url_encode(role), F.lit(">")) if side == 0 else F.lit(OTHER[1]))


def _render(role: Column, text: Column) -> Column:
    return F.concat(_mark(role, 0), F.lit(" "), text, F.lit(" "), _mark(role, 1), F.lit("\n"))


def _pieces(formatted: Column) -> Column:
    cut = F.split(formatted, f"(?={_CONTROL})")
    return F.filter(cut, lambda p: F.length(p) > 0)


def _role(opened: Column) -> Column:
    known = F.when(F.lit(False), F.lit(""))
    for name, (mark, _) in MARKS.items():
        known = known.when(opened.startswith(mark + " "), F.lit(name))
    return known.otherwise(F.try_url_decode(F.regexp_extract(opened, r"^<turn:([^> ]*)> ", 1)))


def parse(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation, null if it does not fit the grammar."""

    def turn(opened: Column, closed: Column) -> Column:
        role = _role(opened)
        start = F.char_length(_mark(role, 0)) + 1
        # `open text close`, with one space after open and one before close
        size = F.char_length(opened) - start - 1
        whole = (size >= 0) & opened.startswith(F.concat(_mark(role, 0), F.lit(" "))) & opened.endswith(" ")
        fits = whole & (closed == F.concat(_mark(role, 1), F.lit("\n")))
        return F.when(fits, F.struct(role.alias("role"), unescape(F.substring(opened, start + 1, size)).alias("text")))

    def turns(p: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(p)), lambda i: (i % 2 == 0) & (i < F.size(p)))
        found = F.transform(at, lambda i: turn(F.get(p, i), F.coalesce(F.get(p, i + 1), F.lit(""))))
        return let(found, lambda t: F.when(~F.exists(t, lambda x: x.isNull()), t))

    return let(_pieces(formatted), turns)


def _trips(role: Column, text: Column, written: Column) -> Column:
    """Whether the parser gives back exactly this one turn."""
    return let(
        parse(_render(role, written)),
        lambda t: F.coalesce((F.size(t) == 1) & (F.get(t, F.lit(0))["role"] == role) & (F.get(t, F.lit(0))["text"] == text), F.lit(False)),
    )


def format_chats(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: conv_id, n_turns, formatted, loss_spans, n_escaped, round_trip.

    Turns are ordered by turn, then role and text, so repeated rows are repeated turns in a
    defined order; null turns come first. A null role or text is empty; a null conversation id is
    a conversation of its own. An empty table has no conversations. Other columns are not kept,
    whatever their names.

    A turn that reads back as written stays as it is; any other is escaped, which gives back any
    text. loss_spans are the texts of assistant turns as (start, bytes) in the UTF-8 form of
    `formatted`, in order and without marks. round_trip compares the parsed output with the source;
    it is checked, and a conversation that does not read back fails the job.

    One shuffle by conversation; the turns of a conversation end in one row, as its text does.
    """
    source = df.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    conflict = ~_trips(F.col("role"), F.col("text"), F.col("text"))
    written = source.withColumn("escaped", conflict).withColumn("written", F.when(F.col("escaped"), escape(F.col("text"))).otherwise(F.col("text")))
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    size = F.octet_length(_render(F.col("role"), F.col("written"))).cast("long")
    placed = written.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "start", "written", "escaped")))
    chats = placed.groupBy("conv_id").agg(ordered.alias("turns"))
    chats = chats.withColumn("formatted", F.array_join(F.transform("turns", lambda t: _render(t["role"], t["written"])), ""))
    spans = F.transform(
        F.filter("turns", lambda t: t["role"] == LEARNT),
        lambda t: F.struct(
            (t["start"] + F.octet_length(_mark(t["role"], 0)) + 1).alias("start"), F.octet_length(t["written"]).cast("long").alias("bytes")
        ),
    )
    turns = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    lost = F.raise_error(F.concat(F.lit("conversation does not read back: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        "formatted",
        spans.alias("loss_spans"),
        F.size(F.filter("turns", lambda t: t["escaped"])).cast("long").alias("n_escaped"),
        F.when(F.coalesce(parse(F.col("formatted")) == turns, F.lit(False)), F.lit(True)).otherwise(lost.cast("boolean")).alias("round_trip"),
    )


def loss_text(formatted: Column, loss_spans: Column) -> Column:
    """The unescaped text under the loss mask, read from the formatted conversation."""
    cut = lambda b: F.transform(loss_spans, lambda s: unescape(F.substr(b, (s["start"] + 1).cast("int"), s["bytes"].cast("int")).cast("string")))
    return F.array_join(let(formatted.cast("binary"), cut), "")
