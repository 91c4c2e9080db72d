"""Personal data: patterns propose, checksums confirm, context words adjust, in DataFrame functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    """A proposed kind: its pattern, the score of a confirmed match, and context words."""

    name: str
    pattern: str
    score: float
    context: str
    base: bool = False


# A pattern that begins with a repeated class gets a guard: a match cannot start inside
# a run that an earlier start would have taken whole, so runs are read once. Possessive
# repeats give the same matches without backtracking or recursion.
_EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
_IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_NATIONAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

# The kinds, in the order in which equal starts are listed.
KINDS = (
    Kind("email", _EMAIL, 0.9, r"\b(e-?mail|contact|mailto|write)\b", True),
    Kind("ip", _IP, 0.6, r"\b(ip|address|host|server|login)\b", True),
    Kind("card", _CARD, 0.8, r"\b(card|visa|mastercard|credit|payment|cvv)\b", True),
    Kind("phone", _PHONE, 0.7, r"\b(phone|tel|call|mobile|fax)\b", True),
    Kind("iban", _IBAN, 0.8, r"\b(iban|bank|account|transfer|swift|bic)\b"),
    Kind("national", _NATIONAL, 0.3, r"\b(ssn|social|security|passport|identity|tax)\b"),
)
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.3
# Added kinds count from this score on; a national number has it only near its words.
THRESHOLD = 0.5


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The Luhn checksum over a string of digits, read from the right."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, (n - i).cast("int"), F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """The remainder rule of account numbers: first four characters last, letters as 10..35."""
    plain = F.regexp_replace(account, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "iban":
        return F.when(
            F.length(F.regexp_replace(match, " ", "")).between(15, 34), mod97(match)
        ).otherwise(False)
    return F.lit(True)


def _proposals(text: Column, kind: Kind) -> Column:
    """The leftmost matches that do not overlap, and the lengths of what lies between.

    Together they give the places of the matches, in code points.
    """
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.transform(F.split(text, kind.pattern, -1), F.length)
    return F.struct(matches.alias("m"), gaps.alias("g"))


def _spans(raw: Column, text: Column, kind: Kind, order: int) -> Column:
    """Array of (start, rank, end, kind, score) of confirmed matches of one kind."""
    start_type = "struct<at:bigint,out:array<struct<start:bigint,end:bigint,m:string>>>"

    def step(state: Column, i: Column) -> Column:
        begin = state["at"] + F.element_at(raw["g"], i)
        match = F.element_at(raw["m"], i)
        end = begin + F.length(match)
        placed = F.struct(begin.alias("start"), end.alias("end"), match.alias("m"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(placed)).alias("out"))

    empty = F.struct(
        F.lit(0).cast("bigint").alias("at"),
        F.array().cast("array<struct<start:bigint,end:bigint,m:string>>").alias("out"),
    ).cast(start_type)
    n = F.size(raw["m"])
    placed = F.when(
        n > 0, F.aggregate(F.sequence(F.lit(1), n), empty, step, lambda s: s["out"])
    ).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,m:string>>"))
    sure = F.filter(placed, lambda s: _confirmed(kind.name, s["m"]))

    def scored(s: Column) -> Column:
        near = F.substring(
            text,
            F.greatest(F.lit(1), s["start"] + 1 - CONTEXT_CHARS).cast("int"),
            (s["end"] - s["start"] + 2 * CONTEXT_CHARS).cast("int"),
        )
        bonus = F.when(F.lower(near).rlike(kind.context), CONTEXT_BONUS).otherwise(0.0)
        return F.struct(
            s["start"].alias("start"),
            F.lit(order).alias("rank"),
            s["end"].alias("end"),
            F.lit(kind.name).alias("kind"),
            F.least(F.lit(1.0), F.lit(kind.score) + bonus).alias("score"),
        )

    out = F.transform(sure, scored)
    return out if kind.base else F.filter(out, lambda s: s["score"] >= THRESHOLD)


def find_pii(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with ``pii``: the spans found in ``text``.

    ``pii`` is an array of (start, rank, end, kind, score), sorted by start and kind, in
    code points, end exclusive; a column of that name is replaced. Null and empty texts
    have no spans. The base kinds (email, ip, card, phone) are kept whatever their
    score; account and national numbers only from ``THRESHOLD`` on. Spans of different
    kinds may overlap. Rows are handled one by one, so repeated rows give equal results.
    """
    kept = [c for c in docs.columns if c != "pii"]
    text = F.coalesce(F.col("text"), F.lit(""))
    # Cheap tests first: most texts hold no character that a kind needs.
    digits = text.rlike("[0-9]")
    needs = {"email": text.contains("@"), "phone": text.contains("+") & digits}
    none = F.struct(
        F.array().cast("array<string>").alias("m"), F.array().cast("array<int>").alias("g")
    )
    raws = {
        f"_raw_{k.name}": F.when(needs.get(k.name, digits), _proposals(text, k)).otherwise(none)
        for k in KINDS
    }
    spans = [_spans(F.col(f"_raw_{k.name}"), text, k, i) for i, k in enumerate(KINDS)]
    return (
        docs.select(*kept)
        .withColumns(raws)
        .withColumn("pii", F.array_sort(F.concat(*spans)))
        .select(*kept, "pii")
    )


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def digest(found: DataFrame) -> DataFrame:
    """Per row of ``find_pii``: counts of the base kinds and the spans as text."""
    base = [k.name for k in KINDS if k.base]
    of_base = F.filter("pii", lambda s: s["rank"] < len(base))

    def of_kind(number: int) -> Column:
        return F.size(F.filter("pii", lambda s: s["rank"] == number)).cast("long")

    return found.select(
        "doc_id",
        *[of_kind(i).alias(f"n_{name}") for i, name in enumerate(base)],
        F.sha2(_listed(of_base), 256).alias("base_sha256"),
        _listed(F.col("pii")).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of personal data in ``text`` replaced by its kind in brackets.

    Of overlapping spans the first gives the label and the whole covered stretch goes.
    Texts without spans, and null texts, stay as they are. All columns are kept.
    """
    names = docs.columns
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    found = find_pii(rows)
    parts_type = "array<struct<start:bigint,end:bigint,kind:string>>"

    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        this = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        longer = F.struct(
            last["start"].alias("start"),
            F.greatest(last["end"], s["end"]).alias("end"),
            last["kind"].alias("kind"),
        )
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] > s["start"]), joined).otherwise(
            F.concat(acc, F.array(this))
        )

    merged = F.aggregate("pii", F.array().cast(parts_type), merge)
    text = F.col("text")

    def piece(s: Column, i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0)).otherwise(F.element_at("_merged", F.greatest(i, F.lit(1)))["end"])
        return F.concat(
            F.substring(text, (begin + 1).cast("int"), (s["start"] - begin).cast("int")),
            F.lit("["),
            F.upper(s["kind"]),
            F.lit("]"),
        )

    tail = F.substring(text, (F.element_at("_merged", -1)["end"] + 1).cast("int"), F.length(text))
    cleaned = F.when(F.size("_merged") == 0, text).otherwise(
        F.concat(F.array_join(F.transform("_merged", piece), ""), tail)
    )
    return found.withColumn("_merged", merged).select(
        *[cleaned.alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in names]
    )
