"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 512  # matches whose positions are summed up together
NEAR = 40  # characters on either side in which a context word counts
KEEP = 0.5  # proposals of the kinds that have no base rule need this score

# Patterns. A run of characters is entered at its start only (or where the last match ended), and never
# given back, so time stays in proportion to the text.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
BASE = ("email", "ip", "card", "phone")
#: Score of a confirmed match, and the words that raise it by 0.3.
SCORES = {
    "email": (0.7, "e-?mail|mail|contact|write"), "ip": (0.6, "ip|address|host|server"),
    "card": (0.7, "card|visa|credit|payment"), "phone": (0.6, "phone|tel|call|mobile|fax"),
    "iban": (0.7, "iban|account|bank|konto"), "ssn": (0.3, "ssn|social security|security number"),
}


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, its digits summed: the total ends in 0."""
    turned = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _mod97(iban: Column) -> Column:
    """The first four characters moved to the end, letters read as 10 to 35: the rest by 97 is 1."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 58, (rest * 10 + c - 48) % 97).otherwise((rest * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def confirmed(kind: str, match: Column) -> Column:
    """Whether a match of the kind's pattern passes its check."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return n.between(16, 19) & F.when(n.between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(8, 15)
    if kind == "iban":
        bare = F.regexp_replace(match, " ", "")
        return F.length(bare).between(15, 34) & _mod97(bare)
    return F.lit(True)


def _places(text: Column, pattern: str, found: Column) -> Column:
    """``(start, end, match)`` for every match, in code points, end exclusive.

    The text between matches and the matches alternate, so positions are running sums of their lengths:
    first over blocks of matches, then inside each block.
    """
    between = F.split(text, pattern)
    pieces = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda gap, m: F.struct(
        F.length(gap).alias("gap"), m.alias("match")))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(pieces, b * BLOCK + 1, BLOCK))
    sums = F.transform(blocks, lambda block: F.aggregate(
        block, F.lit(0), lambda total, x: total + x["gap"] + F.length(x["match"])))
    bases = F.aggregate(sums, F.array(F.lit(0)), lambda done, x: F.concat(
        done, F.array(F.element_at(done, -1) + x)))
    empty = F.expr("cast(array() as array<struct<start:int,end:int,match:string>>)")

    def put(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + F.length(x["match"])
        return F.struct(end.alias("at"), F.concat(state["got"], F.array(F.struct(
            start.alias("start"), end.alias("end"), x["match"].alias("match")))).alias("got"))

    return F.flatten(F.zip_with(blocks, F.slice(bases, F.lit(1), F.size(blocks)), lambda block, base: F.aggregate(
        block, F.struct(base.alias("at"), empty.alias("got")), put)["got"]))


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """All columns and ``out``: array of ``(kind, start, end, score)``, by kind, then start.

    Positions count code points from 0, end exclusive. Matches of one kind do not overlap, those of different
    kinds may. Matches of the base kinds (email, ip, card, phone) that pass their check always stay; IBANs
    need their checksum, social security numbers a word nearby that says what they are. A null or empty
    text gives an empty array. A column already named ``out`` is replaced.
    """
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int,score:double>>)")
    held = docs.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    for kind, pattern in PATTERNS.items():
        held = held.withColumn(f"__{kind}", F.regexp_extract_all("__text", F.lit(pattern), F.lit(0)))

    def spans(kind: str) -> Column:
        score, words = SCORES[kind]
        found = F.col(f"__{kind}")
        passed = F.filter(_places(F.col("__text"), PATTERNS[kind], found), lambda x: confirmed(kind, x["match"]))

        def scored(x: Column) -> Column:
            around = F.concat_ws(
                " | ", F.substring("__text", F.greatest(x["start"] - NEAR, F.lit(0)) + 1,
                                   F.least(x["start"], F.lit(NEAR))),
                F.substring("__text", x["end"] + 1, F.lit(NEAR)))
            near = around.rlike(rf"(?i)\b(?:{words})\b")
            return F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                            F.round(F.lit(score) + F.when(near, 0.3).otherwise(0.0), 2).alias("score"))

        kept = F.transform(passed, scored)
        if kind not in BASE:
            kept = F.filter(kept, lambda x: x["score"] >= KEEP)
        return F.when(F.size(found) > 0, kept).otherwise(none)

    return held.withColumn(out, F.concat(*[spans(kind) for kind in PATTERNS])).drop(
        "__text", *[f"__{kind}" for kind in PATTERNS])


def mask_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with each span replaced by its kind in angle brackets; overlapping spans become one.

    All columns stay; a null text stays null.
    """
    found = find_pii(docs, text, "__pii")
    order = F.array_sort(F.transform("__pii", lambda x: F.struct(x["start"], x["end"], x["kind"])))

    def put(state: Column, x: Column) -> Column:
        fresh = x["start"] >= state["at"]
        gap = F.substring(F.col(text), state["at"] + 1, x["start"] - state["at"])
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), F.when(fresh, F.concat(
            state["done"], gap, F.lit("<"), x["kind"], F.lit(">"))).otherwise(state["done"]).alias("done"))

    state = F.aggregate(order, F.struct(F.lit(0).alias("at"), F.lit("").alias("done")), put)
    masked = F.when(F.size("__pii") > 0, F.concat(state["done"], F.substring(
        F.col(text), state["at"] + 1, F.length(F.col(text))))).otherwise(F.col(text))
    return found.withColumn("__masked", masked).select(
        *[F.col("__masked").alias(c) if c == text else F.col(c) for c in docs.columns])
