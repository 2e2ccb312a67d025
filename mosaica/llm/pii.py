"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaica.llm.common import let, table, text_or_empty

# Fixed patterns by kind, in the order of the kinds; iban is what the method adds. Every repeat that can run over a whole text is
# possessive and starts where its run starts or the last match ended (\\G): what follows a run never matches inside it, so the matches are those of
# the plain repeats, in linear time and without recursion.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
}
BASE = ("email", "ip", "card", "phone")
# What a text must hold for the pattern to be tried at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][0-9\x20-]{14}", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}"}
# Fixed words that raise the score of a span when they stand before it.
CONTEXT = {
    "email": "e?mails?|contact|write",
    "ip": "ip|host|server|address",
    "card": "cards?|credit|visa|pay(ment)?",
    "phone": "(tele)?phone|tel|call|mobile|fax",
    "iban": "iban|bank|account|konto",
}
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8}
CONTEXT_CHARS = 40
REPORT = 0.75  # least score of a span that the method adds; spans of the fixed patterns stay whatever their score
CHUNK = 64  # matches whose places are summed together
_OPEN, _CLOSE = "\x01", "\x02"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") * 2 / 10).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number without spaces leaves 1 modulo 97 after its first four characters went to the end."""
    turned = F.concat(F.substring(code, 5, 100), F.substring(code, 1, 4))
    return F.aggregate(
        F.split(turned, ""), F.lit(0),
        lambda a, c: F.when(c == "", a).when(c.between("0", "9"), (a * 10 + c.try_cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
    ) == 1


def valid(kind: str, x: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(x, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) < 4) & F.forall(F.split(x, r"\."), lambda p: F.coalesce(p.try_cast("decimal(38,0)"), F.right(F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))), F.lit(3)).try_cast("int")) <= 255)
    if kind == "card":
        return F.length(_digits(x)).between(16, 19) & luhn(_digits(x))
    if kind == "phone":
        return F.length(_digits(x)).between(8, 15)
    if kind == "iban":
        return F.length(F.replace(x, F.lit(" "))).between(15, 34) & mod97(F.replace(x, F.lit(" ")))
    return F.lit(True)


def _total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0), lambda a, v: a + v)


def spans_of(text: Column, kind: str) -> Column:
    """array<struct<kind, start, end, value, before>> of the pattern's leftmost matches that do not overlap, code points, end exclusive;
    before holds up to CONTEXT_CHARS characters in front, back to the match before.

    Matches are wrapped in two control characters, which no pattern contains (those of the text are turned into a third
    first, so lengths stay), and the lengths of the pieces between them give the places: sums over whole chunks of matches, then
    within a chunk, so that a text of many matches costs little more than its length.
    """
    clean = F.translate(text, _OPEN + _CLOSE, "\x03\x03")
    marked = F.regexp_replace(clean, f"({PATTERNS[kind]})", f"{_OPEN}$1{_CLOSE}")

    def places(parts: Column) -> Column:  # text, match, text, match, ..., text
        return let(F.transform(parts, F.char_length), lambda lengths: let(
            F.transform(F.sequence(F.lit(0), F.floor(F.size(parts) / (2 * CHUNK)).cast("int")), lambda c: _total(F.slice(lengths, c * (2 * CHUNK) + 1, F.lit(2 * CHUNK)))),
            lambda sums: let(
                F.aggregate(sums, F.array(F.lit(0)), lambda a, v: F.concat(a, F.array(F.element_at(a, -1) + v))),
                lambda before: F.transform(
                    F.filter(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(2)) - 1), lambda i: (i % 2 == 1) & (i < F.size(parts))),
                    lambda i: let(
                        F.get(before, F.floor(i / (2 * CHUNK)).cast("int")) + _total(F.slice(lengths, F.floor(i / (2 * CHUNK)).cast("int") * (2 * CHUNK) + 1, i % (2 * CHUNK))),
                        lambda start: F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.get(lengths, i)).alias("end"), F.get(parts, i).alias("value"), F.lower(F.right(F.get(parts, i - 1), F.lit(CONTEXT_CHARS))).alias("before")),
                    ),
                ),
            ),
        ))

    spans = let(F.split(marked, f"[{_OPEN}{_CLOSE}]"), places)
    return F.when(text.rlike(HINTS[kind]), F.filter(spans, lambda x: valid(kind, x.value)))


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat(x.kind, F.lit(":"), x.start.cast("string"), F.lit(":"), x.end.cast("string"))), ",")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, found), one row per input row; found lists kind, start, end, value and score of every span, by kind, then start.

    Cards must pass Luhn, account numbers (iban) modulo 97. A span's score is its kind's, plus 0.15 if a word of the kind's
    context stands within CONTEXT_CHARS code points before it and after the kind's span before (1 at most), and 0.1 less if a card or iban
    continues a number that starts with +, as a phone number does. Account numbers are found only with a score of REPORT or more; the other kinds always.
    A null text counts as empty and has no spans. Repeated rows and null ids pass through; an empty table
    gives an empty result.
    """
    t = text_or_empty(text_col)
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int,value:string,before:string>>)")
    out = docs.select(F.col(id_col).alias("id"), t.alias("t"))
    for kind in PATTERNS:
        out = out.withColumn(kind, F.coalesce(spans_of(F.col("t"), kind), none))

    def scored(kind: str) -> Column:
        def of(x: Column) -> Column:
            near = F.when(x.before.rlike(rf"\b(?:{CONTEXT[kind]})\b"), 0.15).otherwise(0.0)
            clash = F.when(x.before.rlike(r"\+[0-9\x20().-]*$"), 0.1).otherwise(0.0) if kind in ("card", "iban") else F.lit(0.0)
            return F.struct(x.kind.alias("kind"), x.start.alias("start"), x.end.alias("end"), x.value.alias("value"), F.least(F.lit(1.0), F.round(F.lit(SCORES[kind]) + near - clash, 2)).alias("score"))

        spans = F.transform(F.col(kind), of)
        return spans if kind in BASE else F.filter(spans, lambda x: x.score >= REPORT)

    return out.select(F.col("id").alias(id_col), F.concat(*[scored(k) for k in PATTERNS]).alias("found"))


def op10_personal_data(spark, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda x: x.kind.isin(*BASE))
    count = [F.size(F.filter(found.found.kind, lambda x: x == F.lit(k))).cast("long").alias(f"n_{k}") for k in BASE]
    scores = F.array_join(F.transform("found", lambda x: x.score.cast("string")), ",")
    return found.select("doc_id", *count, F.sha2(_digest(base), 256).alias("base_sha256"), _digest(F.col("found")).alias("spans"), scores.alias("scores"))


QUERIES = {"op10_personal_data": op10_personal_data}
ORACLE: dict[str, str] = {}
