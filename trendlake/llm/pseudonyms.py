"""Format-preserving pseudonyms of personal data, in SQL expressions only.

Cards, phone numbers, social-security numbers, IPv4 addresses, dates and mail addresses
are found by pattern, validated, and replaced by a keyed permutation of their own format:
a balanced Feistel network over the numbers (or characters) that the format allows. So a
pseudonym is valid wherever its original was, equal values stay equal in all documents,
and whoever has the key can reverse it. Round functions are SHA-256 of the key, the kind,
the round and the other half.

============  =====================================  ==========================================
kind          validated by                           permuted
============  =====================================  ==========================================
card          length 13 to 19 and the Luhn digit     all digits but the last, which is computed
phone         North American plan, or a + prefix     area and line (all digits after the prefix)
ssn           no reserved area, group or serial      the numbers that remain
ip            four numbers up to 255                 the 32 bits
date          a day of the years 1800 to 2199        the days of those 400 years
mail          a name, @ and a dotted host            letters and digits of the name
============  =====================================  ==========================================

Defined results: null text stays null, text without personal data stays as it is, invalid
values stay; equal rows give equal rows; an empty table gives none. Texts of any length
are read whole. Input columns are not changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.functions.lookup import let

ROUNDS = 8
KINDS = ("mail", "date", "ip", "ssn", "card", "phone")

# Each pattern starts where no word character precedes it, so a run is tried once.
MAIL = r"(?<![\w.%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,8}"
DATE = r"(?<![\w/.-])(?:(?:18|19|20|21)\d\d-\d\d-\d\d|\d\d/\d\d/(?:18|19|20|21)\d\d|\d\d\.\d\d\.(?:18|19|20|21)\d\d)(?![\w/-])"
IP = r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\w]|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
_AREA = r"(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"
_FOURS = r"\d{4}(?: \d{4}){3}"
_GROUPED = rf"(?:{_FOURS}|\d{{4}}(?:-\d{{4}}){{3,4}}|\d{{4}} \d{{6}} \d{{4,5}}|\d{{4}}-\d{{6}}-\d{{4,5}}|\d{{13,19}})(?![\w-])"
# What a number after a space may be instead of one more group of the value before it.
_OTHER = rf"\d++[:/]\d|{DATE}|{IP}|{SSN}|(?:\+?1[ .-]?)?{_AREA}"
# Usual groups first, with three digits more where only the check digit can tell a long card from a card and its code;
# then any groups, up to a number that is something else.
CARD = (
    rf"(?<![\w-])(?:{_FOURS} (?!{_OTHER}|{_GROUPED})\d{{3}}(?![\w-]|[.,/:]\d)|{_GROUPED}"
    rf"|(?!{_OTHER})\d(?:(?! (?:{_OTHER}|{_GROUPED}))[ -]?\d){{12,18}}(?![\w-]))"
)
# A phone ends before cards. Groups of four digits are cards as far as fours of them fill the rest of the run.
_NEXT = rf"{_OTHER}|(?!{_FOURS}){_GROUPED}|{_FOURS}(?: {_FOURS})*+(?! \d{{4}}(?!\w)|[\w-])"
_GROUP = r"\(?\d{2,4}\)?"
PHONE = (
    rf"(?<![\w+])(?:\+?1[ .-]?)?{_AREA}"
    rf"|(?<![\w+])\+\d{{1,3}}(?:(?:[.-]| (?!{_NEXT}))?{_GROUP}){{2}}(?:(?:[.-]| (?!{_NEXT}|\d++[.,]\d))?{_GROUP}){{0,2}}(?!\w)"
)
ANY = rf"(?<!\w)(?:{MAIL}|(?=[\d(+])(?:{DATE}|{IP}|{SSN}|{CARD}|{PHONE}))"
LONG_WALK = 1_024  # a card of 19 digits is permuted until its first 16 are a card as before; nine of ten, or one of ten, are
WALK = 64  # a day that may only be shown day first is permuted until it is one again; two of five are not


def _digest(secret: str, kind: str, turn: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(secret), F.lit(kind), turn.cast("string"), value.cast("string")), 256)


def feistel(secret: str, kind: str, left: Column, right: Column, a: int | Column, b: int | Column, back: bool = False) -> Column:
    """struct(l, r): a keyed permutation of the pairs below (a, b)."""
    a, b = (x.cast("long") if isinstance(x, Column) else F.lit(x).cast("long") for x in (a, b))
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"), a.alias("a"), b.alias("b"))

    def forth(s: Column, turn: Column) -> Column:
        keyed = F.conv(F.substring(_digest(secret, kind, turn, s["r"]), 1, 14), 16, 10).cast("long")
        return F.struct(s["r"].alias("l"), ((s["l"] + keyed) % s["a"]).alias("r"), s["b"].alias("a"), s["a"].alias("b"))

    def undo(s: Column, turn: Column) -> Column:
        keyed = F.conv(F.substring(_digest(secret, kind, turn, s["l"]), 1, 14), 16, 10).cast("long")
        return F.struct(F.pmod(s["r"] - keyed, s["b"]).alias("l"), s["l"].alias("r"), s["b"].alias("a"), s["a"].alias("b"))

    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(turns, start, undo if back else forth)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _number(value: Column, width: int | Column) -> Column:
    width = width if isinstance(width, Column) else F.lit(width)
    return F.call_function("lpad", value.cast("string"), width.cast("int"), F.lit("0"))


def _as_formatted(original: Column, digits: Column) -> Column:
    """``digits`` in the places of the original's digits."""

    def placed(c: Column, i: Column) -> Column:
        nth = F.length(_digits(F.substring(original, F.lit(1), i + 1)))
        return F.when(c.between("0", "9"), F.substring(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(original, ""), placed), "")


def permuted_digits(secret: str, kind: str, digits: Column, back: bool = False) -> Column:
    """A permutation of the digit strings of one length (2 to 36)."""
    half = F.floor(F.length(digits) / 2).cast("int")
    rest = F.length(digits) - half
    left, right = F.substring(digits, F.lit(1), half), F.substring(digits, half + 1, rest)
    pair = feistel(secret, kind, left, right, F.pow(F.lit(10.0), half), F.pow(F.lit(10.0), rest), back)
    return let(pair, lambda p: F.concat(_number(p["l"], half), _number(p["r"], rest)))


def luhn_digit(digits: Column) -> Column:
    """The check digit that follows ``digits``."""
    doubled = F.transform(
        F.reverse(F.split(digits, "")),
        lambda c, i: F.when(i % 2 == 0, F.when(c >= "5", c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")),
    )
    return ((F.lit(10) - F.aggregate(doubled, F.lit(0), lambda s, x: s + x) % 10) % 10).cast("string")


def _checked(digits: Column) -> Column:
    """Whether the last digit is the check digit of the others."""
    return luhn_digit(F.substring(digits, F.lit(1), F.length(digits) - 1)) == F.right(digits, F.lit(1))


def _card(secret: str, value: Column, back: bool) -> Column:
    """Four groups of four digits that are a card stay one, whatever three digits follow."""

    def permuted(body: Column) -> Column:
        def again(d: Column) -> Column:
            return permuted_digits(secret, "card", d, back)

        def starts_alike(d: Column) -> Column:
            return _checked(F.substring(d, 1, 16)) == _checked(F.substring(body, 1, 16))

        turns = F.when(F.length(body) == 18, F.sequence(F.lit(1), F.lit(LONG_WALK))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(turns, again(body), lambda d, _: F.when(starts_alike(d), d).otherwise(again(d)))

    def replaced(own: Column) -> Column:
        digits = _digits(own)
        new = let(permuted(F.substring(digits, F.lit(1), F.length(digits) - 1)), lambda d: F.concat(d, luhn_digit(d)))
        tail = F.substring(value, F.length(own) + 1, F.length(value))
        return F.when(_checked(digits), F.concat(_as_formatted(own, new), tail))

    followed = value.rlike(rf"^{_FOURS} \d{{3}}$") & _checked(_digits(F.substring(value, 1, 19)))
    return let(F.when(followed, F.substring(value, 1, 19)).otherwise(value), replaced)


def _ssn(secret: str, value: Column, back: bool) -> Column:
    area, group, serial = (F.substring(value, p, n).cast("int") for p, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)  # 898 areas
    pair = feistel(secret, "ssn", place * 99 + group - 1, serial - 1, 898 * 99, 9_999, back)

    def shown(p: Column) -> Column:
        place = F.floor(p["l"] / 99)
        area = F.when(place >= 665, place + 2).otherwise(place + 1)
        return F.concat_ws("-", _number(area, 3), _number(p["l"] % 99 + 1, 2), _number(p["r"] + 1, 4))

    return F.when(valid, let(pair, shown))


def _ip(secret: str, value: Column, back: bool) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("int"))
    high, low = (F.element_at(parts, i) * 256 + F.element_at(parts, i + 1) for i in (1, 3))
    pair = feistel(secret, "ip", high, low, 1 << 16, 1 << 16, back)
    new = let(pair, lambda p: F.concat_ws(".", *(x.cast("string") for h in ("l", "r") for x in (F.floor(p[h] / 256), p[h] % 256))))
    return F.when(F.array_max(parts) <= 255, new)


def _phone(secret: str, value: Column, back: bool) -> Column:
    """Ten digits of the North American plan keep valid area and exchange codes; others keep their country prefix."""
    digits = _digits(value)
    ten, prefix = F.right(digits, F.lit(10)), F.substring(digits, F.lit(1), F.length(digits) - 10)
    plan = ten.rlike("^[2-9][0-9]{2}[2-9]") & prefix.isin("", "1") & (F.length(digits) >= 10)
    area, exchange, line = (F.substring(ten, p, n).cast("long") for p, n in ((1, 3), (4, 3), (7, 4)))
    whole = ((area - 200) * 800 + exchange - 200) * 10_000 + line
    pair = feistel(secret, "phone", F.floor(whole / 80_000), whole % 80_000, 80_000, 80_000, back)

    def shown(p: Column) -> Column:
        whole = p["l"] * 80_000 + p["r"]
        codes = F.floor(whole / 10_000)
        return F.concat(prefix, (F.floor(codes / 800) + 200).cast("string"), (codes % 800 + 200).cast("string"), _number(whole % 10_000, 4))

    code = F.length(_digits(F.regexp_extract(value, r"^\+\d{1,3}", 0)))
    country, rest = F.substring(digits, F.lit(1), code), F.substring(digits, code + 1, F.length(digits))
    abroad = F.when(value.startswith("+"), F.concat(country, permuted_digits(secret, "abroad", rest, back)))
    return _as_formatted(value, F.coalesce(F.when(plan, let(pair, shown)), abroad))


def _day_first(day: Column) -> Column:
    return F.dayofmonth(day) > 12


def _date(secret: str, value: Column, back: bool) -> Column:
    """400 years have 146,097 = 189 * 773 days. With slashes the month comes first, unless it cannot."""
    origin = F.lit("1800-01-01").cast("date")

    def permuted(day: Column) -> Column:
        number = F.datediff(day, origin)
        pair = feistel(secret, "date", F.floor(number / 773), number % 773, 189, 773, back)
        return let(pair, lambda p: F.date_add(origin, (p["l"] * 773 + p["r"]).cast("int")))

    def walked(day: Column) -> Column:
        again = F.sequence(F.lit(1), F.lit(WALK))
        return F.aggregate(again, permuted(day), lambda d, _: F.when(_day_first(d), d).otherwise(permuted(d)))

    def shown(pattern: str, permute) -> Column:
        day = F.to_date(F.try_to_timestamp(value, F.lit(pattern)))
        return F.when(day.isNotNull(), F.date_format(permute(day), pattern))

    month_first = F.coalesce(shown("MM/dd/yyyy", permuted), shown("dd/MM/yyyy", walked))
    return F.when(value.contains("/"), month_first).when(value.contains("."), shown("dd.MM.yyyy", permuted)).otherwise(shown("yyyy-MM-dd", permuted))


def _shifted(text: Column, digest: Column, sign: int) -> Column:
    """Letters and digits moved within their own class by the bytes of ``digest``."""

    def moved(c: Column, i: Column) -> Column:
        by = F.conv(F.substring(digest, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int") * sign
        code = F.ascii(c)
        out = c
        for first, size in ((48, 10), (65, 26), (97, 26)):
            inside = code.between(first, first + size - 1)
            out = F.when(inside, F.chr((F.pmod(code - first + by, F.lit(size)) + first).cast("long"))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(text, ""), moved), "")


def _mail(secret: str, value: Column, back: bool) -> Column:
    name, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    half = F.floor(F.length(name) / 2).cast("int")
    start = F.struct(F.substring(name, F.lit(1), half).alias("l"), F.substring(name, half + 1, F.length(name)).alias("r"))

    def forth(s: Column, turn: Column) -> Column:
        return F.struct(s["r"].alias("l"), _shifted(s["l"], _digest(secret, "mail", turn, s["r"]), 1).alias("r"))

    def undo(s: Column, turn: Column) -> Column:
        return F.struct(_shifted(s["r"], _digest(secret, "mail", turn, s["l"]), -1).alias("l"), s["l"].alias("r"))

    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return let(F.aggregate(turns, start, undo if back else forth), lambda s: F.concat(s["l"], s["r"], F.lit("@"), host))


_KINDS = ((MAIL, _mail), (DATE, _date), (IP, _ip), (SSN, _ssn), (CARD, _card), (PHONE, _phone))


def _tagged(kind: str):
    return lambda text: F.when(text.isNotNull(), F.struct(F.lit(kind).alias("kind"), text.alias("text")))


def pseudonym(value: Column, secret: str, back: bool = False) -> Column:
    """struct(kind, text) of one found value; the kind is null and the text as it was when the value is not valid."""
    plain = F.struct(F.lit(None).cast("string").alias("kind"), value.alias("text"))
    choice = None
    for kind, (pattern, replace) in zip(KINDS, _KINDS, strict=True):
        fits, new = value.rlike(f"^(?:{pattern})$"), let(replace(secret, value, back), _tagged(kind))
        choice = F.when(fits, new) if choice is None else choice.when(fits, new)
    return F.coalesce(choice, plain)


def pseudonymised(text: Column, secret: str, back: bool = False) -> Column:
    """struct(text, kinds): the text with pseudonyms in place, and the kind of each replaced value."""
    nothing = F.struct(text.alias("text"), F.array().cast("array<string>").alias("kinds"))

    def joined(hits: Column) -> Column:
        gaps = F.split(text, ANY, -1)  # the same matches, so one gap more than hits
        own = F.array_append(F.transform(hits, lambda h: h["text"]), F.lit(""))
        kinds = F.filter(F.transform(hits, lambda h: h["kind"]), lambda k: k.isNotNull())
        return F.struct(F.array_join(F.zip_with(gaps, own, lambda g, t: F.concat(g, t)), "").alias("text"), kinds.alias("kinds"))

    def replaced(found: Column) -> Column:
        hits = F.transform(found, lambda v: pseudonym(v, secret, back))
        return F.when(F.size(found) > 0, let(hits, joined)).otherwise(nothing)

    return let(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), replaced)


def _count(kind: str) -> Column:
    return F.size(F.filter("done.kinds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")


def replace_personal(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text", back: bool = False) -> DataFrame:
    """(key, text, n_mail, n_date, n_ip, n_ssn, n_card, n_phone) of every row."""
    done = docs.select(F.col(key).alias(key), pseudonymised(F.col(text), secret, back).alias("done"))
    return done.select(key, F.col("done.text").alias("text"), *map(_count, KINDS))
