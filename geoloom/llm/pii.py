"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust their score.

Everything is done by Spark's own functions within a row: nothing is shuffled, and no Python runs. A pattern's
matches and the pieces of text between them are two arrays; running sums of their lengths give the spans. The sums
are made in blocks of the square root of their number, so that a text of a million matches is no quadratic work.

Patterns take whole runs of characters (possessively) and start only where a run does, so that no text makes them
quadratic; what they match is the same.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:int,end:int,score:double,base:boolean>"
#: Spans that the base rules do not ask for are kept from this score on.
THRESHOLD = 0.5
#: So many characters before a match are searched for words that make it likelier.
CONTEXT_CHARS = 40
#: What such a word adds to the score.
CONTEXT_GAIN = 0.35

_LOCAL = r"[A-Za-z0-9._%+-]"
_LABEL = r"[A-Za-z0-9-]"
_BYTE = r"0*+(?:[1-9][0-9]?|1[0-9][0-9]|2[0-4][0-9]|25[0-5])?"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, r"[^0-9]", "")


def _has_digits(least: int, most: int) -> Callable[[Column], Column]:
    return lambda m: F.char_length(_digits(m)).between(least, most)


def _card(least: int, most: int) -> Callable[[Column], Column]:
    """Between so many digits, that pass Luhn's check."""
    return lambda m: _has_digits(least, most)(m) & F.call_function("luhn_check", _digits(m))


def mod97(found: Column) -> Column:
    """Whether an account number's check digits are right: with its first four characters last, letters from A = 10, it is 1 modulo 97."""
    bare = F.replace(found, F.lit(" "), F.lit(""))
    signs = F.split(F.concat(F.substr(bare, F.lit(5)), F.substr(bare, F.lit(1), F.lit(4))), "")

    def add(rest: Column, sign: Column) -> Column:
        code = F.ascii(sign)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).when(code >= 48, (rest * 10 + code - 48) % 97).otherwise(rest)

    return F.aggregate(signs, F.lit(0), add) == 1


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: A text that does not match this has no match of the pattern.
    hint: str
    valid: Callable[[Column], Column]
    score: float
    words: tuple[str, ...]
    base: bool = False
    #: Text right before the match that makes it part of something else.
    not_after: str | None = None


_CARD_WORDS = ("card", "visa", "mastercard", "maestro", "credit", "debit", "karte", "kreditkarte", "carte", "tarjeta")
_PHONE_WORDS = ("phone", "telephone", "tel", "call", "mobile", "cell", "fax", "telefon", "anruf", "handy", "teléfono", "llamar", "téléphone", "appeler", "portable")

#: The base rules' patterns and bounds, and the order of kinds, are fixed values.
RULES = (
    Rule("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++", "@", lambda m: F.lit(True), 0.9, ("mail", "e-mail", "email", "contact"), base=True),
    Rule("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", lambda m: m.rlike(rf"\A{_BYTE}(?:\.{_BYTE}){{3}}\z"), 0.55, ("ip", "host", "server", "address"), base=True),
    Rule("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){13}", _card(14, 19), 0.65, _CARD_WORDS, base=True),
    Rule("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", _has_digits(10, 15), 0.6, _PHONE_WORDS, base=True),
    # What the method adds.
    Rule("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}[ A-Z0-9]{11}", mod97, 0.6, ("iban", "account", "bank", "konto", "compte", "cuenta")),
    Rule("card", r"(?<![0-9+])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,12}(?![ -]?[0-9])", r"[0-9](?:[ -]?[0-9]){11}", _card(12, 13), 0.3, _CARD_WORDS),
    Rule("phone", r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])", r"[0-9]{3}[ .-][0-9]{4}", lambda m: F.lit(True), 0.35, _PHONE_WORDS, not_after=r"\+[0-9][ ().0-9-]*\z"),
    Rule("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-", lambda m: F.lit(True), 0.35, ("ssn", "social security", "security number")),
    Rule("ipv6", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", r"(?:[0-9A-Fa-f]{1,4}:){7}", lambda m: F.lit(True), 0.6, ("ip", "host", "server", "address")),
    Rule("email", rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+ ?[\[(] ?at ?[\])] ?{_LABEL}++(?: ?[\[(] ?dot ?[\])] ?{_LABEL}++)++", r"[\[(] ?at ?[\])]", lambda m: F.lit(True), 0.6, ("mail", "e-mail", "email", "contact")),
)

#: Base kinds in their fixed order, then the others.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "ipv6")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _running(steps: Column) -> Column:
    """steps: array of (gap, size), in order. Returns an array of (start, end, at): places in the text, and in steps."""
    none = F.expr("cast(array() as array<struct<start:int,end:int,at:int>>)")
    begin = F.struct(F.lit(0).alias("to"), none.alias("out"))
    count = F.size(steps)
    width = F.ceil(F.sqrt(count)).cast("int")

    def block(first: Column) -> Column:
        def add(acc: Column, at: Column) -> Column:
            start = acc["to"] + steps[at]["gap"]
            end = start + steps[at]["size"]
            return F.struct(end.alias("to"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), at.alias("at")))).alias("out"))

        return F.aggregate(F.sequence(first, F.least(first + width, count) - 1), begin, add)

    def join(acc: Column, part: Column) -> Column:
        moved = F.transform(part["out"], lambda s: F.struct((s["start"] + acc["to"]).alias("start"), (s["end"] + acc["to"]).alias("end"), s["at"].alias("at")))
        return F.struct((acc["to"] + part["to"]).alias("to"), F.concat(acc["out"], moved).alias("out"))

    blocks = F.transform(F.sequence(F.lit(0), count - 1, width), block)
    return F.when(count > 0, F.aggregate(blocks, begin, join)["out"]).otherwise(none)


def _spans(text: Column, rule: Rule) -> Column:
    """The rule's spans in a text, in order."""
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    words = r"(?iu)(?<![\p{L}\p{N}])(?:" + "|".join(rule.words) + r")(?![\p{L}\p{N}])"

    def told(x: Column) -> Column:
        steps = F.transform(x["found"], lambda m, i: F.struct(F.char_length(F.get(x["between"], i)).alias("gap"), F.char_length(m).alias("size")))

        def span(s: Column) -> Column:
            near = F.right(F.get(x["between"], s["at"]), F.lit(CONTEXT_CHARS))
            score = F.lit(rule.score) + F.when(near.rlike(words), CONTEXT_GAIN).otherwise(0.0)
            return F.struct(F.lit(rule.kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.least(score, F.lit(1.0)).alias("score"), F.lit(rule.base).alias("base"))

        def stays(s: Column) -> Column:
            fits = rule.valid(F.get(x["found"], s["at"]))
            if rule.not_after:
                fits &= ~F.right(F.get(x["between"], s["at"]), F.lit(CONTEXT_CHARS)).rlike(rule.not_after)
            return fits

        made = F.transform(F.filter(_let(steps, _running), stays), span)
        return made if rule.base else F.filter(made, lambda s: s["score"] >= THRESHOLD)

    both = F.struct(F.split(text, rule.pattern, -1).alias("between"), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("found"))
    may = F.contains(text, F.lit("@")) if rule.hint == "@" else text.rlike(rule.hint)
    return F.when(may, _let(both, told)).otherwise(none)


def personal_data(text: Column) -> Column:
    """Array of (kind, start, end, score, base), by start, then kind as in KINDS, then end; code points, end exclusive. Null: none.

    base tells the spans of the base rules (email, ip, card, phone), which stay whatever their score. The others
    are kept from THRESHOLD on. Spans of different rules may overlap.
    """
    text = F.coalesce(text, F.lit(""))
    order = F.array(*(F.lit(k) for k in KINDS))

    def key(s: Column) -> Column:
        return F.struct(s["start"].alias("a"), F.array_position(order, s["kind"]).alias("b"), s["end"].alias("c"), s.alias("d"))

    every = F.concat(*(_spans(text, r) for r in RULES))
    return F.transform(F.sort_array(F.transform(every, key)), lambda k: k["d"])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, spans (array of kind, start, end, score, base; see personal_data).

    Whole texts are searched. Null and empty texts: no spans. Repeated rows: one result each. Other columns are not
    read. Nothing is shuffled.
    """
    return docs.select(docs[id_col].alias("doc_id"), personal_data(docs[text_col]).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
