"""Personal data in texts: patterns, checksums and context, as column expressions.

A pattern proposes spans, a validator confirms them (Luhn for cards, mod 97 for IBANs,
number ranges for addresses), and words near a span move its score. All of it is
Spark SQL functions over one row; nothing is shuffled.

Patterns are written so that a long run of one character class is read once: groups
are possessive, and a run may only be entered at its start or where the match before
ended (``\\G``). Neither changes what is found.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    """One kind of data: its pattern, score and the words that speak for it.

    `needs` is a string that every match holds; a text without it is not searched. With
    `ahead` the pattern matches only the head of a value, and its group what follows.
    """

    name: str
    pattern: str
    prior: float
    cues: str
    base: bool = True
    needs: str = ""
    ahead: bool = False


# Characters before and after a span in which its cue words count.
WINDOW = 48


def _run(chars: str, rest: str) -> str:
    """A run of `chars`, from its start or the end of the match before, then `rest`."""
    return rf"(?:\G|(?<![{chars}]))[{chars}]++{rest}"


# The base patterns of the contract, in its order, then those added here.
KINDS = (
    Kind(
        "email",
        _run("A-Za-z0-9._%+-", r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
        0.9,
        "mail|email|e-mail|contact|write",
        needs="@",
    ),
    Kind("ip", _run("0-9", r"(?:\.[0-9]++){3}"), 0.6, "ip|host|server|address|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.7, "card|visa|mastercard|credit|payment|pay"),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        0.6,
        "phone|tel|call|mobile|fax|contact",
        needs="+",
    ),
    Kind(
        "iban",
        rf"(?<![A-Za-z0-9])[A-Z]{{2}}[0-9]{{2}}(?=((?:\x20?[A-Z0-9]){{11,30}}+[\s\S]{{0,{WINDOW}}}))",
        0.8,
        "iban|bank|account|transfer",
        False,
        ahead=True,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        0.5,
        "ssn|social|security",
        False,
    ),
)
BASE = [k.name for k in KINDS if k.base]
# The characters of an IBAN by country. Other countries and lengths are found too, where
# mod 97 holds.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22,
    "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27,
    "GT": 28, "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20,
    "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24,
    "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25,
    "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
    "YE": 30,
}
_LENGTHS = "".join(f"{country}{length}" for country, length in IBAN_LENGTHS.items())
CUE_BONUS = 0.2
# Matches that are worked on together.
BLOCK = 256
SPAN = (
    "array<struct<start:bigint,rank:int,kind:string,end:bigint,score:double,value:string>>"
)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of `value` pass the Luhn check."""
    figures = F.reverse(F.split(digits(value), ""))
    doubled = F.transform(
        F.filter(figures, lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            F.element_at(
                F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1
            )
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether `value` is an IBAN by its check digits."""
    plain = F.upper(F.regexp_replace(value, r"\x20", ""))
    turned = F.concat(F.substring(plain, 5, 34), F.substring(plain, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda a, c: F.when(c == "", a)
        .when(c.between("0", "9"), (a * 10 + c.cast("int")) % 97)
        .otherwise((a * 100 + F.ascii(c) - 55) % 97)
        .cast("int"),
    )
    return F.length(plain).between(15, 34) & (rest == 1)


def _iban_rest(head: Column, ahead: Column) -> Column:
    """How many characters of `ahead` end the IBAN that begins with `head`, or null.

    Words that follow may look like parts of it, so each end of a word is tried. The
    length of the country decides, then the longest that passes mod 97.
    """
    code = F.instr(F.lit(_LENGTHS), F.substring(head, 1, 2))
    usual = F.when(
        code > 0, F.substring(F.lit(_LENGTHS), code + 2, F.lit(2)).try_cast("int")
    )
    body = F.length(F.regexp_extract(ahead, r"^(?:\x20?[A-Z0-9])+", 0))

    def whole(n: Column) -> Column:
        return F.concat(head, F.substring(ahead, F.lit(1), n))

    ends = F.filter(
        F.sequence(F.lit(11), body),
        lambda n: F.substring(ahead, n, F.lit(2)).rlike("^[A-Z0-9](?![A-Za-z0-9])") & mod97(whole(n)),
    )
    by_country = F.filter(ends, lambda n: F.length(F.replace(whole(n), F.lit(" "))) == usual)
    return F.coalesce(F.array_max(by_country), F.array_max(ends))


def octets(value: Column) -> Column:
    """Whether all parts of a dotted number are at most 255, leading zeros aside."""
    parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(
        parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255)
    )


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return octets(value)
    if kind == "card":
        return F.length(digits(value)).between(12, 19) & luhn(value)
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


PAIR = "array<struct<gap:string,value:string,next:string>>"


def _pairs(text: Column, kind: Kind) -> Column:
    """Each match of a kind with the text before it and after it, up to other matches.

    The text between matches and the matches themselves come from the same pattern. The
    last pair has no match. Of heads, what the pattern saw ahead is the text after.
    """
    between = F.split(text, kind.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    after = F.slice(between, 2, 1 << 30)
    if kind.ahead:
        after = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1))
    pairs = F.arrays_zip(between, matches, after).cast(PAIR)
    if kind.needs:
        pairs = F.when(F.contains(text, F.lit(kind.needs)), pairs).otherwise(F.array().cast(PAIR))
    return pairs


def _blocks(pairs: str) -> Column:
    """An array in blocks of at most BLOCK, as appending to a long array copies it."""
    last = F.floor((F.size(pairs) - 1) / BLOCK).cast("int")
    every = F.sequence(F.lit(0), F.greatest(last, F.lit(0)))
    return F.transform(every, lambda b: F.slice(pairs, b * BLOCK + 1, BLOCK))


def _spans(blocks: str, rank: int, kind: Kind) -> Column:
    """All confirmed spans of one kind, in order.

    The lengths of all that lies before give a span's place: first block by block, then
    within each.
    """
    none = F.array().cast(SPAN)

    def add(acc: Column, block: Column) -> Column:
        length = F.aggregate(
            block,
            F.lit(0).cast("bigint"),
            lambda a, p: a + F.length(p["gap"]) + F.coalesce(F.length(p["value"]), F.lit(0)),
        )
        return F.struct(
            (acc["at"] + length).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")
        )

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        through = start + F.length(pair["value"])
        value, after, end = pair["value"], F.substring(pair["next"], 1, WINDOW), through
        good = value.isNotNull() & valid(kind.name, value)
        if kind.ahead:
            rest = _iban_rest(value, pair["next"])
            good = value.isNotNull() & rest.isNotNull()
            value = F.concat(value, F.substring(pair["next"], F.lit(1), rest))
            after = F.substring(pair["next"], rest + 1, F.lit(WINDOW))
            end = through + rest
        near = F.concat(F.substring(pair["gap"], -WINDOW, WINDOW), F.lit(" "), after)
        bonus = F.when(F.lower(near).rlike(rf"\b(?:{kind.cues})\b"), CUE_BONUS).otherwise(0.0)
        span = F.struct(
            start.alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(kind.name).alias("kind"),
            end.alias("end"),
            F.least(F.lit(1.0), F.lit(kind.prior) + bonus).alias("score"),
            value.alias("value"),
        )
        return F.struct(
            F.coalesce(through, acc["at"]).cast("bigint").alias("at"),
            F.when(good, F.concat(acc["found"], F.array(span).cast(SPAN)))
            .otherwise(acc["found"])
            .alias("found"),
        )

    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("all"))
    starts = F.aggregate(blocks, zero, add, lambda acc: acc["all"])
    return F.flatten(
        F.zip_with(
            blocks,
            starts,
            lambda block, at: F.aggregate(
                block, F.struct(at.alias("at"), none.alias("found")), step, lambda acc: acc["found"]
            ),
        )
    )


def _apart(blocks: str) -> Column:
    """Spans without those that begin inside a span before them."""

    def step(acc: Column, span: Column) -> Column:
        clear = span["start"] >= acc["until"]
        return F.struct(
            F.when(clear, span["end"]).otherwise(acc["until"]).alias("until"),
            F.when(clear, F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).alias("found"),
        )

    def add(acc: Column, block: Column) -> Column:
        zero = F.struct(acc["until"].alias("until"), F.array().cast(SPAN).alias("found"))
        part = F.aggregate(block, zero, step)
        return F.struct(
            part["until"].alias("until"), F.concat(acc["all"], F.array(part["found"])).alias("all")
        )

    zero = F.struct(
        F.lit(0).cast("bigint").alias("until"), F.array().cast(f"array<{SPAN}>").alias("all")
    )
    return F.flatten(F.aggregate(blocks, zero, add, lambda acc: acc["all"]))


def find_pii(docs: DataFrame, min_score: float = 0.0) -> DataFrame:
    """`docs` with ``pii``: the spans of personal data in each ``text``, by place.

    A span has ``start`` and ``end`` in code points (end exclusive), its ``kind``, the
    ``rank`` of the kind in KINDS, a ``score`` from 0 to 1 and the ``value``. Matches of
    one kind are the leftmost that do not overlap; one that its validator refuses is
    dropped. An IBAN is tried at every head, so one that is refused hides none. Kinds may overlap each other; equal places stand in the order of KINDS.
    Spans below `min_score` are left out. A null or empty text has none; repeated rows
    are judged each; an empty table stays empty. Other columns stay as they are, but
    for a column ``pii``, which is replaced.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "pii"]).alias("row")
    names = [k.name for k in KINDS]
    # Each step is a projection of its own, so that what it reads twice is worked out once.
    pairs = docs.select(row, *[_pairs(text, k).alias(k.name) for k in KINDS])
    blocks = pairs.select("row", *[_blocks(n).alias(n) for n in names])
    each = blocks.select("row", *[_spans(k.name, i, k).alias(k.name) for i, k in enumerate(KINDS)])
    for name in [k.name for k in KINDS if k.ahead]:
        each = each.withColumn(name, _blocks(name)).withColumn(name, _apart(name))
    spans = F.concat(*names)
    if min_score > 0:
        spans = F.filter(spans, lambda s: s["score"] >= min_score)
    return each.select("row.*", F.array_sort(spans).alias("pii"))


def redact(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """`docs` with every span of at least `min_score` in ``text`` replaced by its kind.

    Of spans that overlap, the first counts, and the later one is cut where it ends; a
    null text stays null.
    """
    found = find_pii(docs, min_score)
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, span: Column) -> Column:
        gap = F.col("text").substr(
            (acc["at"] + 1).cast("int"), F.greatest(span["start"] - acc["at"], F.lit(0)).cast("int")
        )
        mark = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(acc["at"], span["end"]).cast("bigint").alias("at"),
            F.when(span["end"] > acc["at"], F.concat(acc["out"], F.array(gap, mark)))
            .otherwise(acc["out"])
            .alias("out"),
        )

    row = F.struct(*[F.col(f"`{c}`") for c in found.columns if c != "pii"]).alias("row")
    cut = found.select(row, F.col("text"), F.aggregate("pii", state, step).alias("cut"))
    rest = F.col("text").substr((F.col("cut")["at"] + 1).cast("int"), F.length("text"))
    text = F.concat(F.array_join(F.col("cut")["out"], ""), rest)
    return cut.select(F.col("row").withField("text", text).alias("row")).select("row.*")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def span_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
