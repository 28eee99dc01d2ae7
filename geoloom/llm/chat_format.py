"""Chat formatting that is proved by parsing it again.

Grammar of a formatted conversation:

    conversation := turn*
    turn         := "### " role ": " text "</turn>\\n"

`### ` and `</turn>` are control strings and must occur exactly once per turn. Texts are first
rendered as they are, and the result is parsed by the deterministic parser below. Where the
turns recovered are not those that were put in, or a control string occurs elsewhere, the
conversation's texts are escaped and it is rendered and parsed again; if even that did not give
the turns back, the job would stop. Escaping doubles every backslash and then breaks each
control string by a backslash after its first character; the parser drops each backslash and
keeps what follows it, so that the two undo each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings and the sign that breaks them.
OPEN, MIDDLE, CLOSE, SIGN = "### ", ": ", "</turn>", "\\"


def _broken(control: str) -> str:
    return control[0] + SIGN + control[1:]


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit(SIGN), F.lit(SIGN * 2))
    for control in (CLOSE, OPEN):
        text = F.replace(text, F.lit(control), F.lit(_broken(control)))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(MIDDLE), F.lit(_broken(MIDDLE)))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _render(turns: Column, escaped: bool) -> Column:
    """Formatted text of an array of (role, text)."""
    form = escape if escaped else (lambda c: c)
    form_role = escape_role if escaped else (lambda c: c)
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), form_role(t["role"]), F.lit(MIDDLE), form(t["text"]), F.lit(CLOSE + "\n"))), "")


def _segments(formatted: Column) -> Column:
    """What stands between a turn's opening and its close, for each turn."""
    pieces = F.split(formatted, CLOSE + "\n", -1)
    return F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))


def _split_segment(segment: Column) -> tuple[Column, Column]:
    """Escaped role and escaped text of a segment."""
    at = F.instr(segment, MIDDLE)
    role = F.substring(segment, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
    return role, F.substring(segment, at + len(MIDDLE), F.char_length(segment))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text)."""

    def turn(segment: Column) -> Column:
        role, text = _split_segment(segment)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(_segments(formatted), turn)


def _count(text: Column, control: str) -> Column:
    return (F.char_length(text) - F.char_length(F.replace(text, F.lit(control), F.lit("")))) / len(control)


def _faithful(formatted: Column, turns: Column) -> Column:
    n = F.size(turns)
    return (parse(formatted) == turns) & (_count(formatted, OPEN) == n) & (_count(formatted, CLOSE) == n)


def loss_spans(formatted: Column, trained_role: str = "assistant") -> Column:
    """Spans (start, length), in characters from 0, of the escaped texts of the turns whose role is trained on."""

    def add(state: Column, segment: Column) -> Column:
        role, text = _split_segment(segment)
        start = state["at"] + F.char_length(segment) - F.char_length(text)
        span = F.struct(start.alias("start"), F.char_length(text).alias("length"))
        spans = F.when(unescape(role) == trained_role, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + F.char_length(segment) + len(CLOSE) + 1).alias("at"), spans.alias("spans"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    return F.aggregate(_segments(formatted), first, add, lambda s: s["spans"])


def span_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped text of each span."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, escaped (whether its texts had to be).

    Rows are put in the order of turn, null first, then role, then text; equal rows are all
    kept. Null roles and texts count as empty. A null conversation id makes one conversation.
    Empty input: empty result. Other columns are not read. A conversation is one text and so
    one row: it must fit into memory, as its digest needs it whole.
    """
    row = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    turns = F.transform(F.array_sort("rows"), lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text")))
    talks = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.collect_list(row).alias("rows")).select("conv_id", turns.alias("turns"))
    plain = talks.withColumn("plain", _render(F.col("turns"), False))
    tried = plain.withColumn("escaped", ~_faithful(F.col("plain"), F.col("turns")))
    made = tried.withColumn("formatted", F.when(F.col("escaped"), _render(F.col("turns"), True)).otherwise(F.col("plain")))
    proved = F.when(~F.col("escaped") | _faithful(F.col("formatted"), F.col("turns")), F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("not read back as it was: conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))).cast("string")
    )
    return made.select("conv_id", proved.alias("formatted"), "escaped").withColumn("loss_spans", loss_spans(F.col("formatted"), trained_role))
