"""Personal data: patterns propose, validators confirm, nearby words adjust the score.

Built-in functions only: every document is judged in the scan, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.spans import count, spans

# Fixed values. Quantifiers are possessive and starts are guarded, so that no text takes more than
# linear time or deep recursion; the matches are those of the plain patterns that can be valid.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# The characters of an account number by country, so that a match ends where the number does.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_KNOWN = "|".join("|".join(codes.split()) for codes in IBAN_LENGTHS.values())
_BY_COUNTRY = "|".join(
    rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}"
    for n, codes in IBAN_LENGTHS.items()
)
_OTHERS = rf"(?!{_KNOWN})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}+"
IBAN = rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_BY_COUNTRY}|{_OTHERS})(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
LOCAL_PHONE = r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _small_parts(match: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(match, r"\."), small)


def luhn(match: Column) -> Column:
    """13 to 19 digits whose check digit is right."""
    digits = _digits(match)
    return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)


def mod_97(match: Column) -> Column:
    """An account number whose check digits are right: moved to the end, letters as 10 to 35, the
    number leaves 1 when divided by 97."""
    bare = F.replace(match, F.lit(" "))
    moved = F.concat(F.substr(bare, F.lit(5)), F.left(bare, F.lit(4)))

    def add(rest: Column, char: Column) -> Column:
        value = F.ascii(char) - F.when(char.between("0", "9"), 48).otherwise(55)
        return (rest * F.when(value < 10, 10).otherwise(100) + value) % 97

    chars = F.array_remove(F.split(moved, ""), "")
    return F.aggregate(chars, F.lit(0), add) == 1


def _n_digits(least: int, most: int):
    return lambda match: F.length(_digits(match)).between(least, most)


@dataclass(frozen=True)
class Kind:
    """What is looked for: the score is ``prior``, plus ``weight`` if a context word is near.

    A span that passes ``valid`` is kept if it is ``base`` or its score reaches the threshold.
    """

    name: str
    pattern: str
    valid: object
    prior: float
    context: str
    base: bool = True
    weight: float = 0.3
    needs: str = ""


_PHONE_WORDS = r"(?i)\b(tel|phone|call|fax|mobile|cell)\b"

KINDS = (
    Kind("email", EMAIL, None, 0.7, r"(?i)\b(e-?mail|contact|write|reply|mailto)\b", needs="@"),
    Kind("ip", IP, _small_parts, 0.5, r"(?i)\b(ip|host|server|address|login|ping)\b"),
    Kind("card", CARD, luhn, 0.6, r"(?i)\b(card|visa|credit|debit|payment|karte|tarjeta|carte)\b"),
    Kind("phone", PHONE, _n_digits(9, 15), 0.6, _PHONE_WORDS, needs="+"),
    Kind("iban", IBAN, mod_97, 0.6, r"(?i)\b(iban|account|bank|konto|cuenta|compte)\b", base=False),
    Kind("ssn", SSN, None, 0.3, r"(?i)\b(ssn|social security)\b", base=False),
    Kind("local_phone", LOCAL_PHONE, None, 0.3, _PHONE_WORDS, base=False),
)


def _found(text: Column, kind: Kind, threshold: float) -> Column:
    def judged(span: Column) -> Column:
        near = span["before"].rlike(kind.context) | span["after"].rlike(kind.context)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            span["start"].alias("start"),
            span["end"].alias("end"),
            (F.lit(kind.prior) + F.when(near, kind.weight).otherwise(0.0)).alias("score"),
        )

    found = spans(text, kind.pattern)
    if kind.valid is not None:
        found = F.filter(found, lambda span: kind.valid(span["match"]))
    found = F.transform(found, judged)
    if not kind.base:
        found = F.filter(found, lambda span: span["score"] >= threshold)
    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    return F.when(F.contains(text, F.lit(kind.needs)), found).otherwise(empty)


def find_pii(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """The personal data of each document, a row per row of ``docs``.

    Returns ``doc_id`` and ``spans``, an array of (kind, start, end, score) by kind as in ``KINDS``,
    then by start. Kinds of the base (e-mail, IP address, card, phone) keep every valid match;
    the others (account number, social security number, phone without country code) only those
    whose score, raised by context words up to 40 code points away, reaches ``threshold``, and that
    overlap no base span. A null or empty text has no spans, a long one is searched whole, and rows
    that share an id or a text have what their text has. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = [_found(text, kind, threshold) for kind in KINDS if kind.base]
    added = [_found(text, kind, threshold) for kind in KINDS if not kind.base]
    found = docs.select(
        F.col(id_col).alias("doc_id"),
        F.concat(*base).alias("_base"),
        F.concat(*added).alias("_more"),
    )
    apart = F.filter(
        "_more",
        lambda more: ~F.exists(
            "_base", lambda b: (b["start"] < more["end"]) & (more["start"] < b["end"])
        ),
    )
    return found.select("doc_id", F.concat("_base", apart).alias("spans"))


def pii_digest(found: DataFrame) -> DataFrame:
    """Counts and digests of ``find_pii``: base kinds counted and hashed, all spans as text, and
    their scores (``scores``, in the order of ``spans``, in hundredths)."""
    names = [kind.name for kind in KINDS if kind.base]

    def listed(which: Column) -> Column:
        return F.array_join(
            F.transform(which, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def of(name: str) -> Column:
        return count(F.filter("spans", lambda s: s["kind"] == name))

    base = F.filter("spans", lambda s: s["kind"].isin(names))
    return found.select(
        "doc_id",
        *(of(name).alias(f"n_{name}") for name in names),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.array_join(
            F.transform("spans", lambda s: F.round(100 * s["score"]).cast("int").cast("string")), ","
        ).alias("scores"),
    )
