"""Personal data in texts, by DataFrame expressions only: patterns propose, checksums confirm, context adjusts the score."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    """pattern: what proposes spans. gate: a cheap pattern that every text with a span has. valid: of the matched string.
    context: words near a span, before or after, that raise its score. need: least score at which a span is reported."""

    name: str
    gate: str
    pattern: str
    valid: Callable[[Column], Column]
    prior: float
    context: str
    need: float = 0.0
    mask: str = ""


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _mod97(match: Column) -> Column:
    """Whether an account number's check digits are right: its first four characters put last, letters as 10 to 35."""
    match = F.regexp_replace(match, "[ -]", "")
    turned = F.concat(F.substring(match, 5, 99), F.substring(match, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code <= 57, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)

    return F.aggregate(F.filter(F.split(turned, "(?!^)"), lambda c: c != ""), F.lit(0), step) == 1


#: The length of an account number by country, for those that are printed with spaces or hyphens.
_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FO|GL|NL", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|XK", 21: "CH|CR|HR|LI|LV", 22: "BG|BH|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG",
    25: "PT|ST", 26: "IS|TR", 27: "FR|GR|IT|MC|MR|SM", 28: "AL|AZ|CY|DO|GT|HU|LB|PL", 29: "BR|PS|QA|UA", 30: "JO|KW|MU", 31: "MT|SC",
}
_BROKEN = "|".join(f"(?:{countries})[0-9]{{2}}(?:[ -]?[A-Z0-9]){{{n - 4}}}" for n, countries in _LENGTHS.items())
_OTHER = f"(?!{'|'.join(_LENGTHS.values())})[A-Z]{{2}}[0-9]{{2}}(?:[ -][A-Z0-9]{{4}}){{2,7}}(?:[ -][A-Z0-9]{{1,3}})?"
_IBAN = rf"(?<![A-Za-z0-9])(?:[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}|{_BROKEN}|{_OTHER})(?![A-Za-z0-9])"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

#: The base kinds, in the order in which they are listed, then the added ones. Possessive groups and the look-behinds make
#: each pattern linear in the text (a failed start inside a run can't match later in that run) and don't recurse; after a match, \\G lets the next
#: one begin where it ended.
BASE = (
    Kind("email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda m: F.lit(True), 0.8, "mail|contact|write|address", mask="[EMAIL]"),
    Kind("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda m: m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"), 0.6, "ip|host|server|address|from", mask="[IP]"),
    Kind("card", r"[0-9](?:[ -]?[0-9]){11}", r"[0-9](?:[ -]?[0-9])++", lambda m: F.length(_digits(m)).between(12, 19) & F.call_function("luhn_check", _digits(m)), 0.7, "card|visa|credit|pay|account", mask="[CARD]"),
    Kind("phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]", lambda m: F.length(_digits(m)).between(9, 15), 0.6, "phone|tel|call|mobile|fax|contact", mask="[PHONE]"),
)
ADDED = (
    Kind("iban", r"[A-Z]{2}[0-9]{2}[ -]?[A-Z0-9]", _IBAN, _mod97, 0.8, "iban|account|bank|transfer", mask="[IBAN]"),
    Kind("national_id", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", lambda m: F.lit(True), 0.3, "ssn|social|security|national|tax", need=0.5, mask="[ID]"),
)
KINDS = (*BASE, *ADDED)
NEAR, RAISE, CHUNK = 40, 0.2, 256
#: Matches that NEAR characters can hold: a match and the gap before it have three characters at least.
HELD = NEAR // 3 + 1
_SPAN = "struct<start:int,end:int,score:double>"


def _parts(text: Column, kind: Kind) -> tuple[Column, Column]:
    """What stands between the matches, and the matches. A text without the gate's pattern isn't searched."""
    some = text.rlike(kind.gate)
    gaps = F.when(some, F.split(text, kind.pattern, -1)).otherwise(F.array(text))
    return gaps, F.when(some, F.regexp_extract_all(text, F.lit(kind.pattern), 0)).otherwise(F.array().cast("array<string>"))


def _score(kind: Kind, gaps: Column, found: Column, k: Column) -> Column:
    """The score of match k (from 0), by the NEAR characters of the text on each side, whatever matches lie in them. They are put together
    from the few gaps and matches around it, so that no place of a long text has to be looked up."""
    first = F.greatest(k - HELD, F.lit(0))
    joined = lambda g, m: F.array_join(F.zip_with(g, m, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    left = F.transform(F.slice(gaps, first + 1, k - first + 1), lambda g: F.right(g, F.lit(NEAR)))
    right = F.transform(F.slice(gaps, k + 2, F.lit(HELD + 1)), lambda g: F.left(g, F.lit(NEAR)))
    before = F.right(joined(left, F.slice(found, first + 1, k - first)), F.lit(NEAR))
    after = F.left(joined(right, F.slice(found, k + 2, F.lit(HELD))), F.lit(NEAR))
    near = lambda side: F.lower(side).rlike(rf"(?:^|[^a-z])(?:{kind.context})")
    return F.when(near(before) | near(after), F.lit(min(1.0, kind.prior + RAISE))).otherwise(F.lit(kind.prior))


def _scores(kind: Kind, gaps: Column, found: Column) -> Column:
    """The score of each match; null for those that aren't valid or score too little."""

    def one(match: Column, k: Column) -> Column:
        score = F.when(F.coalesce(kind.valid(match), F.lit(False)), _score(kind, gaps, found, k))
        return F.when(score >= kind.need, score)

    return F.transform(found, one)


def _spans(kind: Kind) -> Column:
    """Spans of a kind from its gaps and matches: a running sum of lengths, in chunks so that the work is linear."""
    found = F.col(f"{kind.name}_found")
    pairs = F.arrays_zip(F.slice(f"{kind.name}_gaps", F.lit(1), F.size(found)).alias("gap"), found.alias("match"), F.col(f"{kind.name}_scores").alias("score"))
    empty = F.array().cast(f"array<{_SPAN}>")

    def one(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        span = F.struct(start.alias("start"), end.alias("end"), x["score"].alias("score"))
        good = x["score"].isNotNull()
        return F.struct(end.alias("at"), F.when(good, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def chunk(acc: Column, at: Column) -> Column:
        inner = F.aggregate(F.slice(pairs, at, F.lit(CHUNK)), F.struct(acc["at"].alias("at"), empty.alias("out")), one)
        return F.struct(inner["at"].alias("at"), F.concat(acc["out"], F.array(inner["out"])).alias("out"))

    n = F.size(f"{kind.name}_scores")  # a second use of the scores, so that they are made once and not in each chunk
    starts = F.when(n > 0, F.sequence(F.lit(1), n, F.lit(CHUNK))).otherwise(F.array().cast("array<int>"))
    whole = F.aggregate(starts, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{_SPAN}>>").alias("out")), chunk)
    return F.flatten(whole["out"])


def find_pii(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """-> (doc_id, found array<struct<start, rank, kind, end, score>>), spans by start and then by kind as listed.

    Offsets are code points, the end exclusive. Base kinds are reported whenever their checks hold; of the added
    kinds, account numbers need right check digits and national ids a context word near by. Null or empty
    texts have no spans; repeated rows each give a row. One pass, no shuffle, no Python.
    """
    rows = documents.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = []
    for kind in kinds:
        gaps, found = _parts(F.col("text"), kind)
        parts += [gaps.alias(f"{kind.name}_gaps"), found.alias(f"{kind.name}_found")]
    split = rows.select("doc_id", *parts)
    split = split.select("*", *(_scores(kind, F.col(f"{kind.name}_gaps"), F.col(f"{kind.name}_found")).alias(f"{kind.name}_scores") for kind in kinds))

    def named(rank: int, kind: Kind) -> Column:
        return F.transform(_spans(kind), lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"), s["end"].alias("end"), s["score"].alias("score")))

    each = [named(rank, kind) for rank, kind in enumerate(kinds)]
    return split.select("doc_id", F.array_sort(F.concat(*each)).alias("found"))


def redact(documents: DataFrame, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """The rows with each confirmed span of the text replaced by its kind's mask, one kind after the other; null stays null."""
    for kind in kinds:
        documents = documents.withColumn(text_col, _masked(F.col(text_col), kind))
    return documents


def _masked(text: Column, kind: Kind) -> Column:
    def piece(match: Column, score: Column) -> Column:
        return F.when(score.isNotNull(), F.lit(kind.mask)).otherwise(match)

    gaps, found = F.split(text, kind.pattern, -1), F.regexp_extract_all(text, F.lit(kind.pattern), 0)
    return F.when(text.rlike(kind.gate), F.array_join(F.zip_with(gaps, F.zip_with(found, _scores(kind, gaps, found), piece), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")).otherwise(text)


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_digests(documents: DataFrame) -> DataFrame:
    found = find_pii(documents)
    base = F.filter("found", lambda s: s["rank"] < len(BASE))

    def count(rank: int) -> Column:
        return F.size(F.filter("found", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{BASE[rank].name}")

    counts = [count(rank) for rank in range(len(BASE))]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"), F.array_max(F.transform("found", lambda s: s["score"])).alias("top_score"))
