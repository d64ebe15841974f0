"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust the score.

DataFrame expressions only. Every pattern is written so that Java's matcher
stays linear on long runs: possessive loops, and a look-behind that refuses a
start inside a run already tried (``\\G`` lets a match begin right behind the
last one).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Matches equal the plain forms of the contract:
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+     ip [0-9]+(\.[0-9]+){3}
#   card  [0-9]([\x20-]?[0-9])+   phone \+[0-9][\x20().0-9-]+[0-9]
# A card is a whole run of that form with 13 to 19 digits, so the pattern names only those runs.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # added by this method
    # Only the four characters in front are matched; group 1 is the longest run an account number could fill, and
    # one character more, so that the number may end before the words that follow and the next one is tried as well.
    "iban": r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+[A-Za-z0-9]?))[A-Z]{2}[0-9]{2}",
    # not behind a digit, or a digit and separators: that is a longer number
    "tel": r"(?<![0-9])(?<![0-9][\x20().-])(?<![0-9][\x20.-]\()\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}
IBAN_HEAD = 4
IBAN_SIZES = range(34, 14, -1)
# Characters of an account number by country, as registered; of any other country each size is tried, the longest first.
IBAN_LENGTHS = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 "
    "FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 "
    "LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 "
    "SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}
BASE = ("email", "ip", "card", "phone")
KINDS = tuple(PATTERNS)
# A character without which no match exists: most texts skip the pattern.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
CONTEXT = {
    "email": "mail|contact|write|correo|courriel|kontakt",
    "ip": r"\bip\b|host|server|address|login",
    "card": "card|visa|master|credit|payment|tarjeta|carte|karte",
    "phone": "phone|tel|call|mobile|fax|cell|llama|anruf",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "tel": "phone|tel|call|mobile|fax|cell|llama|anruf",
}
# Score of a span whose form and checksum hold, before the context words.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "tel": 0.4}
WINDOW = 40
SPAN = "array<struct<kind:string,start:int,end:int,text:string,score:double>>"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    each = F.transform(values, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number passes ISO 7064 mod 97-10 (spaces are ignored)."""
    flat = F.regexp_replace(iban, " ", "")
    moved = F.concat(F.substr(flat, F.lit(5)), F.substr(flat, F.lit(1), F.lit(4)))
    value = lambda c: F.when(F.ascii(c) >= 65, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda a, c: F.when(
        c == "", a).when(F.ascii(c) >= 65, (a * 100 + value(c)) % 97).otherwise((a * 10 + value(c)) % 97)) == 1


def account(run: Column) -> Column:
    """The account number that a run (group 1 of the pattern) starts with, or null: it ends with a word and passes mod 97."""
    ends = F.array(*[F.regexp_extract(run, rf"^[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - IBAN_HEAD}}}(?![A-Za-z0-9])", 0) for n in IBAN_SIZES])
    lengths = F.create_map(*[F.lit(x) for c in IBAN_LENGTHS.items() for x in c])
    size = lambda c: F.length(F.regexp_replace(c, " ", ""))
    fits = F.filter(ends, lambda c: (c != "") & (size(c) == F.coalesce(lengths[F.substr(c, F.lit(1), F.lit(2))], size(c))))
    return F.get(F.filter(fits, mod97), F.lit(0))


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        value = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(value(p)) <= 3) & (F.substr(value(p), F.lit(1), F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        return m.isNotNull()
    return F.lit(True)


def _proposed(kind: str, text: Column) -> tuple[Column, Column]:
    """The matches of one kind, and the pieces of text between them, whose lengths add up to the starts.

    Of account numbers the whole number or null, while the pieces are those between their heads.
    """
    p = F.lit(PATTERNS[kind])
    hits = F.transform(F.regexp_extract_all(text, p, F.lit(1)), account) if kind == "iban" else F.regexp_extract_all(text, p, F.lit(0))
    if kind in NEEDS:
        hits = F.when(F.instr(text, NEEDS[kind]) > 0, hits).otherwise(F.array().cast("array<string>"))
    gaps = F.when(F.size("_hits") > 0, F.split(text, PATTERNS[kind], -1)).otherwise(F.array().cast("array<string>"))
    return hits, gaps


def _spans(kind: str, text: Column) -> Column:
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("to"), F.array().cast("array<struct<start:int,end:int,text:string>>").alias("got"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("text")))
        valid = _valid(kind, x["hit"])
        at = end
        if kind == "iban":  # heads are matched inside a number as well
            valid, at = valid & (start >= acc["to"]), start + IBAN_HEAD
        return F.struct(at.alias("at"), F.when(valid, end).otherwise(acc["to"]).alias("to"),
                        F.when(valid, F.concat(acc["got"], one)).otherwise(acc["got"]).alias("got"))

    pairs = F.zip_with("_hits", F.slice("_gaps", 1, F.size("_hits")), lambda h, g: F.struct(h.alias("hit"), g.alias("gap")))
    found = F.aggregate(pairs, zero, step, lambda acc: acc["got"])

    def scored(s: Column) -> Column:
        begin = F.greatest(s["start"] - WINDOW, F.lit(0))
        near = F.lower(F.concat(F.substr(text, begin + 1, s["start"] - begin), F.lit(" "), F.substr(text, s["end"] + 1, F.lit(WINDOW))))
        score = F.lit(SCORES[kind]) + F.when(near.rlike(CONTEXT[kind]), F.lit(0.1 if kind != "tel" else 0.4)).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"),
                        F.round(score, 3).alias("score"))

    return F.transform(found, scored)


def find_pii(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """Add ``spans``: all personal data in the whole text, by kind as in ``KINDS``, then start.

    A span has its kind, start and end (code points, end exclusive), text and
    score. Emails, addresses, cards and phones always stay; account numbers
    must pass mod 97 in the length of their country, whatever word follows, and local phone numbers (``tel``) must reach ``least``,
    which takes a context word within 40 characters, and must not touch a
    card or phone. A null or empty text has no spans. Each row is judged by
    itself, so repeated rows get equal spans. An existing column ``spans`` is
    replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs
    for kind in KINDS:
        out = out.withColumn("_hits", _proposed(kind, body)[0]).withColumn("_gaps", _proposed(kind, body)[1])
        out = out.withColumn(f"_{kind}", _spans(kind, body)).drop("_hits", "_gaps")
    taken = F.concat("_card", "_phone")
    tel = F.filter("_tel", lambda s: (s["score"] >= least) & ~F.exists(taken, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))
    return out.withColumn("spans", F.concat(*[tel if k == "tel" else F.col(f"_{k}") for k in KINDS]).cast(SPAN)).drop(*[f"_{k}" for k in KINDS])


def digest(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redact(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """Replace every span by ``[KIND]``; spans that overlap become one, named after the first.

    A text without spans, and a null text, stays as it is.
    """
    found = find_pii(docs, text, least)
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        clear = s["start"] >= acc["at"]
        piece = F.array(F.substr(F.col(text), acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(clear, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(ordered, zero, step, lambda acc: F.concat(F.concat_ws("", acc["out"]), F.substr(F.col(text), acc["at"] + 1)))
    return found.withColumn(text, F.when(F.size("spans") > 0, done).otherwise(F.col(text))).drop("spans")
