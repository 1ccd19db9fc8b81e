"""Format-preserving pseudonyms for personal data, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmill.llm.feistel import permute_pair, strong_mixer

# What each kind looks like. Every pattern can start at few places only (a sign before it rules the rest out)
# and takes runs whole, so that a long text without blanks is read once.
# Groups repeat a bounded number of times, since the matcher calls itself for each: a host name has at most 127 labels.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,126}"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
ISO_DATE = r"(?<![0-9-])(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}(?![0-9-])"
POINT_DATE = r"(?<![0-9.])[0-9]{1,2}\.[0-9]{1,2}\.(?:19|20)[0-9]{2}(?![0-9])"
SLASH_DATE = r"(?<![0-9/])[0-9]{1,2}/[0-9]{1,2}/(?:19|20)[0-9]{2}(?![0-9/])"
ADDRESS = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
PHONE = r"(?<![0-9+])(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
ABROAD = r"(?<![0-9+])\+[0-9](?:[ .()-]{0,2}[0-9]){7,14}(?![0-9])"

KINDS = {"email": EMAIL, "iban": IBAN, "iso_date": ISO_DATE, "point_date": POINT_DATE, "slash_date": SLASH_DATE, "ip": ADDRESS, "ssn": SSN, "card": CARD, "phone": PHONE, "abroad": ABROAD}
ANY = "|".join(KINDS.values())

# Days from 1900-01-01 to 2099-12-31, as a product of two ranges.
YEARS, DAYS_A, DAYS_B = (1900, 2099), 17, 4297


def _let(value: Column, body) -> Column:
    """body(value), with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _number(text: Column) -> Column:
    return F.coalesce(text.cast("long"), F.lit(0).cast("long"))


def _padded(value: Column, width) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def _refilled(layout: Column, digits: Column) -> Column:
    """The layout with its digits replaced one by one."""

    def char(i: Column) -> Column:
        c = F.substring(layout, i, F.lit(1))
        return F.when(c.rlike("[0-9]"), F.substring(digits, F.length(_digits(F.substring(layout, F.lit(1), i))), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(layout)), char), "")


def _permuted_digits(digits: Column, key: Column) -> Column:
    """Another string of as many digits (up to 36): a permutation of all strings of this length."""

    def swap(d: Column) -> Column:
        n = F.length(d)
        cut = F.floor(n / 2).cast("int")
        ten = F.lit(10.0)
        a, b = F.pow(ten, cut).cast("long"), F.pow(ten, n - cut).cast("long")
        pair = permute_pair(_number(F.substring(d, F.lit(1), cut)), _number(F.substring(d, cut + 1, n)), a, b, F.concat_ws("#", key, n), strong_mixer)
        return _let(pair, lambda p: F.concat(F.when(cut > 0, _padded(p["l"], cut)).otherwise(""), _padded(p["r"], n - cut)))

    return F.when(F.length(digits) > 0, _let(digits, swap)).otherwise("")


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of digits; those whose place from the right (0 first) is `doubled` modulo 2 are doubled, less 9 above 9."""
    n = F.length(digits)

    def one(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        return F.when((n - i) % 2 != doubled, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), one), F.lit(0), lambda s, x: s + x)


def luhn_valid(digits: Column) -> Column:
    return _luhn_sum(digits, 1) % 10 == 0


def _rest_of_97(text: Column) -> Column:
    """A text of digits and capital letters (A counts as 10, Z as 35) modulo 97."""

    def step(rest: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), rest * 10 + c.cast("int")).otherwise(rest * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def iban_valid(iban: Column) -> Column:
    """Whether an IBAN without blanks has 15 to 34 characters and leaves 1 modulo 97 with its first four characters at the end."""
    return (F.length(iban) >= 15) & (F.length(iban) <= 34) & (_rest_of_97(F.concat(F.substring(iban, 5, 30), F.substring(iban, 1, 4))) == 1)


def _iban(found: Column, key: Column) -> Column:
    """Country and letters stay, the other digits change, and the check digits follow from them."""

    def change(iban: Column) -> Column:
        country, body = F.substring(iban, 1, 2), F.substring(iban, 5, 30)
        made = _refilled(body, _permuted_digits(_digits(body), F.concat_ws("#", key, F.lit("iban"), country)))
        return _let(made, lambda b: F.concat(country, _padded(98 - _rest_of_97(F.concat(b, country, F.lit("00"))), 2), b))

    def in_layout(new: Column) -> Column:
        def char(i: Column) -> Column:
            c = F.substring(found, i, F.lit(1))
            return F.when(c == " ", c).otherwise(F.substring(new, F.length(F.replace(F.substring(found, F.lit(1), i), F.lit(" "), F.lit(""))), F.lit(1)))

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(found)), char), "")

    plain = F.replace(found, F.lit(" "), F.lit(""))
    return F.when(iban_valid(plain), _let(_let(plain, change), in_layout)).otherwise(found)


def _card(found: Column, key: Column) -> Column:
    """The first digit (the network) stays, the check digit follows from the others."""

    def change(d: Column) -> Column:
        body = F.concat(F.substring(d, 1, 1), _permuted_digits(F.substring(d, F.lit(2), F.length(d) - 2), F.concat_ws("#", key, F.lit("card"), F.substring(d, 1, 1))))
        return _let(body, lambda b: F.concat(b, F.pmod(10 - _luhn_sum(b, 0) % 10, F.lit(10)).cast("string")))

    def valid(d: Column) -> Column:
        return luhn_valid(d) & d.rlike("[1-9]")

    return _let(_digits(found), lambda d: F.when(valid(d), _refilled(found, change(d))).otherwise(found))


def _day(year: Column, month: Column, day: Column) -> Column:
    """The date, or null if there is no such day."""
    return F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def _moved_day(date: Column, key: Column) -> Column:
    def move(i: Column) -> Column:
        pair = permute_pair(F.floor(i / DAYS_B), i % DAYS_B, F.lit(DAYS_A), F.lit(DAYS_B), F.concat_ws("#", key, F.lit("date")), strong_mixer)
        return _let(pair, lambda p: F.date_add(F.lit(f"{YEARS[0]}-01-01").cast("date"), (p["l"] * DAYS_B + p["r"]).cast("int")))

    return _let(F.date_diff(date, F.lit(f"{YEARS[0]}-01-01").cast("date")), move)


def _date(found: Column, key: Column, kind: str) -> Column:
    """Another day of the years 1900 to 2099 in the same notation; with slashes the month comes first unless that is no month."""
    parts = F.split(found, r"[-./]")
    a, b, c = parts[0], parts[1], parts[2]

    def show(date: Column, mask: str) -> Column:
        return F.when(date.isNotNull(), _let(_moved_day(date, key), lambda d: F.date_format(d, mask)))

    if kind == "iso_date":
        return F.coalesce(show(_day(a, b, c), "yyyy-MM-dd"), found)
    if kind == "point_date":
        return F.coalesce(show(_day(c, b, a), "dd.MM.yyyy"), found)
    return F.coalesce(show(_day(c, a, b), "MM/dd/yyyy"), show(_day(c, b, a), "dd/MM/yyyy"), found)


def _ip(found: Column, key: Column) -> Column:
    parts = F.transform(F.split(found, r"\."), lambda p: p.cast("long"))

    def change(p: Column) -> Column:
        pair = permute_pair(p[0] * 256 + p[1], p[2] * 256 + p[3], F.lit(65536), F.lit(65536), F.concat_ws("#", key, F.lit("ip")), strong_mixer)
        return _let(pair, lambda q: F.concat_ws(".", F.floor(q["l"] / 256), q["l"] % 256, F.floor(q["r"] / 256), q["r"] % 256))

    return _let(parts, lambda p: F.when(F.array_max(p) <= 255, change(p)).otherwise(found))


def _ssn(found: Column, key: Column) -> Column:
    """Areas 001 to 899 but 666, groups from 01, serials from 0001."""
    parts = F.transform(F.split(found, "-"), lambda p: p.cast("long"))

    def change(p: Column) -> Column:
        area = p[0] - F.when(p[0] > 666, 2).otherwise(1)
        pair = permute_pair(area * 99 + p[1] - 1, p[2] - 1, F.lit(898 * 99), F.lit(9999), F.concat_ws("#", key, F.lit("ssn")), strong_mixer)

        def show(q: Column) -> Column:
            area = F.floor(q["l"] / 99)
            return F.concat_ws("-", _padded(area + F.when(area >= 665, 2).otherwise(1), 3), _padded(q["l"] % 99 + 1, 2), _padded(q["r"] + 1, 4))

        return _let(pair, show)

    def valid(p: Column) -> Column:
        return (p[0] > 0) & (p[0] < 900) & (p[0] != 666) & (p[1] > 0) & (p[2] > 0)

    return _let(parts, lambda p: F.when(valid(p), change(p)).otherwise(found))


def _phone(found: Column, key: Column, every: bool) -> Column:
    """Ten digits after an optional +1; area and exchange codes start with 2 to 9, before and after.

    With `every`, other numbers change too: those with an area code below 200, and those with only the exchange code below 200,
    are permuted each among themselves, so that no two numbers become one.
    """

    def change(d: Column) -> Column:
        ten = F.right(d, F.lit(10))
        area, exchange = F.substring(ten, 1, 3).cast("long"), F.substring(ten, 4, 3).cast("long")
        low, short = area < 200, exchange < 200

        def of(below: int, only_exchange: int, valid: int) -> Column:
            """One of three values, by the set that the number is in."""
            return F.when(low, F.lit(below)).when(short, F.lit(only_exchange)).otherwise(F.lit(valid))

        areas, exchanges = of(0, 200, 200), of(0, 0, 200)
        tag = F.when(low, F.lit("phone area")).when(short, F.lit("phone exchange")).otherwise(F.lit("phone"))
        pair = permute_pair(area - areas, (exchange - exchanges) * 10000 + F.substring(ten, 7, 4).cast("long"), of(200, 800, 800), of(10_000_000, 2_000_000, 8_000_000), F.concat_ws("#", key, tag), strong_mixer)

        def show(p: Column) -> Column:
            made = F.concat(_padded(p["l"] + areas, 3), _padded(F.floor(p["r"] / 10000) + exchanges, 3), _padded(p["r"] % 10000, 4))
            return _refilled(found, F.concat(F.left(d, F.length(d) - 10), made))

        return _let(pair, show) if every else F.when(~low & ~short, _let(pair, show)).otherwise(found)

    return _let(_digits(found), change)


def _abroad(found: Column, key: Column) -> Column:
    """The first two digits (of the country) stay."""

    def change(d: Column) -> Column:
        head = F.substring(d, 1, 2)
        return _refilled(found, F.concat(head, _permuted_digits(F.substring(d, 3, 20), F.concat_ws("#", key, F.lit("abroad"), head))))

    return _let(_digits(found), change)


def _email(found: Column, key: Column) -> Column:
    """An address made from a keyed hash of the whole address in small letters."""
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("#", key, F.lit("email"), F.lower(found)), 256), 1, 16), F.lit("@example.org"))


def pseudonym(found: Column, key: Column, every_phone: bool = False) -> Column:
    """The pseudonym of a text that is one find of `ANY`; the text itself if it fails its kind's test."""

    def is_kind(pattern: str) -> Column:
        return found.rlike(f"^(?:{pattern})$")

    out = F.when(F.contains(found, F.lit("@")), _email(found, key))
    for kind, pattern in KINDS.items():
        if kind == "email":
            continue
        if kind == "phone":
            made = _phone(found, key, every_phone)
        else:
            made = _date(found, key, kind) if kind.endswith("date") else {"iban": _iban, "ip": _ip, "ssn": _ssn, "card": _card, "abroad": _abroad}[kind](found, key)
        out = out.when(is_kind(pattern), made)
    return out.otherwise(found)


def with_pseudonyms(df: DataFrame, key: str, text: str = "text", length: str | None = "n_chars", count: str | None = None, every_phone: bool = False) -> DataFrame:
    """Replace personal data in a text by pseudonyms of the same format.

    Found and replaced: card numbers (check digit right), IBANs (remainder right), US social security numbers and phone
    numbers of their ranges, international phone numbers, IPv4 addresses, dates from 1900 to 2099 that exist, and mail
    addresses. Numbers and dates are permuted within their format by Feistel rounds keyed by `key`: a valid number becomes
    another valid number, different numbers stay different, and a number becomes the same one in every document. Mail
    addresses become the first 64 bits of a keyed hash. Numbers that fail their test stay, but with `every_phone` a phone
    number of the format is replaced whatever its area and exchange codes are. No digits, signs or blanks around a number
    change.

    Null stays null and empty stays empty; a column `length`, where there is one, is set to the new number of characters of
    changed texts. `count` names a column for the number of replacements. Only column expressions, no shuffle. Keep `key`
    secret: it is part of the query plan, so of Spark's event log.
    """
    secret, body = F.lit(key), F.col(f"`{text}`")
    # Every find holds a digit or an at sign, which most texts lack.
    found = F.when(body.rlike("[0-9@]") & body.rlike(ANY), F.regexp_extract_all(body, F.lit(ANY), F.lit(0)))
    df = df.withColumn("__found", found)
    df = df.withColumn("__made", F.transform("__found", lambda m: pseudonym(m, secret, every_phone)))
    joined = F.array_join(F.flatten(F.zip_with(F.split(body, ANY, -1), "__made", lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    df = df.withColumn("__text", F.when(F.col("__made").isNotNull(), joined).otherwise(body))
    changed = {text: F.col("__text")}
    if length and length in df.columns:
        changed[length] = F.when(F.col("__made").isNotNull(), F.length("__text").cast(df.schema[length].dataType)).otherwise(F.col(f"`{length}`"))
    if count:
        pairs = F.zip_with("__found", "__made", lambda a, b: a != b)
        changed[count] = F.coalesce(F.size(F.filter(pairs, lambda x: x)), F.lit(0)).cast("long")
    return df.withColumns(changed).drop("__found", "__made", "__text")
