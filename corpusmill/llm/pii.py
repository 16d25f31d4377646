"""Personal data: patterns propose spans, checks of their digits confirm them, words nearby adjust the score.

Only DataFrame functions are used. A kind's matches and the gaps between them come from one pattern (``regexp_extract_all`` and
``split`` walk the text alike), and a running sum of their lengths gives the places. The patterns take the same matches as their plain
forms, but neither recurse on long matches (possessive loops) nor start anew inside a run of characters that has failed as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where a run of these characters begins, or where the last match ended.
_EDGE = r"(?:(?<![{0}])|\G)"
#: Characters before a span, and after it, in which context words count.
CONTEXT_CHARS = 40


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. base: spans that stand whatever their score. needs: the text must contain one of them for a match to be possible. context: words near a span that raise its score."""

    name: str
    pattern: str
    base: bool
    needs: tuple[str, ...]
    score: float
    context: str


KINDS = (
    Kind("email", _EDGE.format("A-Za-z0-9._%+-") + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", True, ("@",), 0.9, r"mail|contact"),
    Kind("ip", _EDGE.format("0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", True, (".",), 0.7, r"\bip\b|address|host|server"),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", True, (), 0.8, r"card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", True, ("+",), 0.8, r"phone|tel|call|mobile|fax"),
    Kind("iban", _EDGE.format("A-Z0-9") + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?+(?![A-Z0-9])", False, (), 0.9, r"iban|account|bank"),
    Kind("ssn", _EDGE.format("0-9-") + r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", False, ("-",), 0.3, r"ssn|social security"),
    Kind("secret", r"(?i)(?<![A-Za-z0-9_])(?:api[_-]?key|access[_-]?key|auth[_-]?token|token|secret|passw(?:or)?d)[\"']?[ \t]{0,8}[:=][ \t]{0,8}[\"']?[A-Za-z0-9_/+.=-]{16,}+", False, ("oken", "OKEN", "ecret", "ECRET", "assw", "ASSW", "key", "Key", "KEY"), 0.6, r"key|auth|login|credential"),
    Kind("local_phone", _EDGE.format("0-9(+-") + r"\(?[0-9]{3}\)?[ -][0-9]{3}-[0-9]{4}(?![0-9-])", False, ("-",), 0.3, r"phone|tel\b|call|mobile|fax"),
)
#: What a context word adds to a score, and the score that a span outside the base needs.
CONTEXT_SCORE, LEAST_SCORE = 0.3, 0.55


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the weighted sum of the digits, every second from the right doubled, ends in 0."""
    n = F.length(digits)

    def weight(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), weight), F.lit(0), lambda acc, x: acc + x) % 10 == 0


def mod97(text: Column) -> Column:
    """Whether an account number's letters, as numbers from 10 on, and digits, the first four characters last, leave 1 when divided by 97."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c >= 65, (acc * 100 + (c - 55)) % 97).otherwise((acc * 10 + (c - 48)) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _confirmed(kind: Kind, match: Column) -> Column:
    if kind.name == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return F.regexp_like(match, F.lit(rf"^{part}(?:\.{part}){{3}}$"))
    if kind.name == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind.name == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind.name == "iban":
        return F.when(F.length(F.replace(match, F.lit(" "), F.lit(""))).between(15, 34), mod97(match)).otherwise(False)
    if kind.name == "secret":  # a value of letters and digits, not a word or a number
        value = F.regexp_extract(match, r"^[^:=]*[:=][ \t\"']*(.*)$", 1)
        return F.regexp_like(value, F.lit("[0-9]")) & F.regexp_like(value, F.lit("[A-Za-z]")) & (F.size(F.array_distinct(F.split(value, ""))) > 8)
    if kind.name == "ssn":
        return ~F.regexp_like(match, F.lit(r"^(?:000|666|9)|-00-|-0000$"))
    return F.lit(True)


#: Items of an array that are summed in one go.
SLICE = 256


def _running(values: Column) -> Column:
    """Running sums of an array: within slices, which are then raised by the sums of those before. Time goes with n * (SLICE + n / SLICE ** 2)."""
    nothing = F.array().cast("array<bigint>")

    def scan(a: Column) -> Column:
        return F.aggregate(a, nothing, lambda acc, x: F.concat(acc, F.array(x + F.when(F.size(acc) > 0, F.element_at(acc, -1)).otherwise(F.lit(0).cast("long")))))

    def sliced(a: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / SLICE).cast("int")), lambda c: scan(F.slice(a, c * SLICE + 1, F.lit(SLICE))))

    def raised(parts: Column) -> Column:
        before = F.concat(F.array(F.lit(0).cast("long")), scan(F.transform(parts, lambda p: F.element_at(p, -1))))
        return F.flatten(F.zip_with(parts, F.slice(before, F.lit(1), F.size(parts)), lambda p, o: F.transform(p, lambda x: x + o)))

    return F.when(F.size(values) <= SLICE, scan(values)).otherwise(F.element_at(F.transform(F.array(sliced(values)), raised), 1))


def found(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """docs of (id, text) with an array column for each kind: its spans (start, kind number, end, score), confirmed and above the needed score."""
    for k, kind in enumerate(kinds):
        docs = _with_spans(docs, k, kind)
    return docs


def _with_spans(docs: DataFrame, k: int, kind: Kind) -> DataFrame:
    text = F.col("text")
    possible = F.lit(not kind.needs)
    for part in kind.needs:
        possible = possible | text.contains(part)
    docs = docs.withColumn("hits", F.when(possible, F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    docs = docs.withColumn("fine", F.transform("hits", lambda m: _confirmed(kind, m)))
    # Where no match passes its check, the places aren't needed.
    some = F.exists("fine", lambda x: x)
    docs = docs.withColumn("gaps", F.when(some, F.split(text, kind.pattern, -1)))
    docs = docs.withColumn("steps", F.zip_with(F.slice("gaps", F.lit(1), F.size("hits")), "hits", lambda g, m: (F.length(g) + F.length(m)).cast("long")))
    docs = docs.withColumn("ends", F.when(some, _running(F.col("steps"))).otherwise(F.array().cast("array<bigint>")))

    def span(x: Column) -> Column:
        start = x["ends"] - F.length(x["hits"])
        before = F.substring(text, F.greatest(start + 1 - CONTEXT_CHARS, F.lit(1)).cast("int"), F.least(start, F.lit(CONTEXT_CHARS)).cast("int"))
        near = F.concat_ws("\n", before, F.substring(text, (x["ends"] + 1).cast("int"), F.lit(CONTEXT_CHARS)))
        more = F.when(F.regexp_like(F.lower(near), F.lit(kind.context)), F.lit(CONTEXT_SCORE)).otherwise(F.lit(0.0))
        return F.struct(start.alias("start"), F.lit(k).alias("kind"), x["ends"].alias("end"), (F.lit(kind.score) + more).alias("score"))

    spans = F.transform(F.filter(F.arrays_zip("hits", "fine", "ends"), lambda x: x["fine"]), span)
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] > LEAST_SCORE)
    spans = F.when(some, spans).otherwise(F.array().cast("array<struct<start:bigint,kind:int,end:bigint,score:double>>"))
    return docs.withColumn(f"spans_{kind.name}", spans).drop("hits", "fine", "gaps", "steps", "ends")


def _joined(spans: Column, kinds: tuple[Kind, ...]) -> Column:
    names = F.array(*(F.lit(k.name) for k in kinds))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: tuple[Kind, ...] = KINDS, with_spans: bool = False) -> DataFrame:
    """One row per row of docs: id, a count for each base kind, base_sha256, spans; with ``with_spans`` also ``found``, the spans with scores.

    Base kinds (email, ip, card, phone) are the leftmost matches that don't overlap, of which those that fail their check are dropped. The
    other kinds (account numbers, social security numbers, local phone numbers, and values that are assigned to names such as token or
    password) add spans whose check passes and whose score, raised by a context word within ``CONTEXT_CHARS`` characters before or after, is
    high enough. Places are code points, ends exclusive; spans go by start, then kind. A null text counts as empty. Repeated rows are treated
    alike, null ids stay, an empty table gives an empty result, other columns are ignored. Nothing is shuffled.
    """
    rows = found(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), kinds).drop("text")
    base, every = (F.concat(*(F.col(f"spans_{k.name}") for k in kinds if k.base or more)) for more in (False, True))
    counts = [F.size(f"spans_{k.name}").cast("long").alias(f"n_{k.name}") for k in kinds if k.base]
    out = [F.col("id").alias(id_col), *counts, F.sha2(_joined(base, kinds), 256).alias("base_sha256"), _joined(every, kinds).alias("spans")]
    if with_spans:
        out.append(F.transform(F.array_sort(every), lambda s: F.struct(F.element_at(F.array(*(F.lit(k.name) for k in kinds)), s["kind"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score"))).alias("found"))
    return rows.select(*out)
