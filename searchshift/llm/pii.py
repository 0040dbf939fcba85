"""Pseudonyms that keep the format of what they replace.

Numbers and dates that pass their own validation (check digits, ranges, calendar) are
permuted by a keyed Feistel network inside the set of valid values of the same format:
a card number becomes a card number with a right check digit, a date a date written the same
way. The permutation depends on the key, the kind and the value's digits alone, so equal
values stay linked across documents and spellings, and whoever has the key can go back
(``invert``; a date written month first only where that is unambiguous, and one without leading
zeros may come back with them). Mail addresses and hexadecimal secrets have no format worth keeping and get
keyed digests.

A network step adds a keyed digest of one half to the other, modulo the size of its
radix; halves may have any radix, so no value has to be walked into range.

Kinds, first match wins: mail address; IBAN in capitals (length of its country, or digits only for
countries without one here; check mod 97; digits and letters are permuted apart, each
in their own places); card number of 13 to 19 digits, plain or in groups (Luhn); phone number with +
and country code, 7 to 15 digits in any grouping, or with an area code in brackets, or
three, three and four digits with separators; social security number (valid area, group
and serial); IPv4 address; date (year, month, day, or day and month first, with - / or .,
days and months of one or two digits, 1900 to 2099); secret of 32 to 64 hexadecimal
digits. What looks alike and fails its validation stays as it is. Not covered: national phone numbers in
other groupings, years of two digits, months by name.

Defined results: a null text stays null with nothing found; an empty text stays empty;
repeated rows get equal results; texts of any length are scanned whole; other columns pass
through untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .expressions import let

ROUNDS = 8

MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,8}"
#: Characters after country and check digits, and the countries that have so many.
IBAN_LENGTHS = {
    11: "NO", 12: "BE", 14: "DK|FI|FK|FO|GL|NL|SD", 15: "MK|SI", 16: "AT|BA|EE|KZ|LT|LU|MN|XK", 17: "CH|HR|LI|LV",
    18: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 19: "AE|GI|IL|IQ|OM|SO|TL", 20: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG",
    21: "LY|PT|ST", 22: "IS|TR", 23: "BI|DJ|FR|GR|IT|MC|MR|SM", 24: "AL|AZ|BY|CY|DO|GT|HU|LB|NI|PL|SV",
    25: "BR|EG|PS|QA|UA", 26: "JO|KW|MU|YE", 27: "MT|SC", 28: "LC", 29: "RU"}
IBAN = (r"(?<![A-Za-z0-9])(?=[A-Z]{2}\d{2})(?:"
        + "|".join(rf"(?:{c})\d{{2}}(?:[ -]?[A-Z0-9]){{{n}}}(?![A-Za-z0-9])" for n, c in IBAN_LENGTHS.items())
        + r"|[A-Z]{2}\d{2}(?: ?\d{4}){2,7}(?: ?\d{1,3})?(?![A-Za-z0-9]))")
CARD = (r"(?<![\d.])(?:\d{13,19}|\d{4}-\d{4}-\d{4}-\d{4}|\d{4} \d{4} \d{4} \d{4}"
        r"|\d{4}-\d{6}-\d{5}|\d{4} \d{6} \d{5})(?!\d)")
#: Country code and area code, or area code in brackets, before three and four digits.
AREA_FIRST = (r"(?:(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{3}\) ?|\d{3}[ .-]?)|(?<!\d)\(\d{3}\) ?)"
              r"\d{3}[ .-]?\d{4}(?!\d)")
#: National digits of countries that always have as many; then any number of them.
GAP = r"[ \u00a0\u202f.()/-]{0,2}"
GROUPED = (r"(?<![\d+])\+(?:" + "|".join(rf"{code}(?:{GAP}\d){{{n}}}(?!\d)" for code, n in ((1, 10), (33, 9), (34, 9), (44, 10)))
           + rf"|[1-9](?:{GAP}\d){{6,14}}(?!\d))")
NATIONAL = r"(?<!\d)(?<!\d[.-])(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![.-]?\d)"
PHONE = f"(?:{AREA_FIRST}|{GROUPED}|{NATIONAL})"
#: Country codes have one, two or three digits, told by the first two.
COUNTRY_CODE = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
IPV4 = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)"
DATE = (r"(?<![\d./-])(?:\d{4}(?:-\d{1,2}-|/\d{1,2}/|\.\d{1,2}\.)\d{1,2}"
        r"|\d{1,2}(?:-\d{1,2}-|/\d{1,2}/|\.\d{1,2}\.)\d{4})(?!\d|[./-]\d)")
SECRET = r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z])"
KINDS = {"mail": MAIL, "iban": IBAN, "card": CARD, "phone": PHONE, "ssn": SSN, "ip": IPV4,
         "date": DATE, "secret": SECRET}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())

#: Days from 1900-01-01 to 2099-12-31, as the product of two radices; and the first day.
DATE_RADICES, FIRST_DAY = (17, 4297), -25567
#: Areas 001 to 899 without 666; groups 01 to 99 with serials 0001 to 9999.
SSN_RADICES = (898, 99 * 9999)


def _digest(key: Column, kind: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", key, F.lit(kind), *[p.cast("string") for p in parts]), 256)


def feistel(left: Column, right: Column, radix_left: Column, radix_right: Column, key: Column,
            kind: str, invert: bool = False) -> Column:
    """Struct (l, r): the permuted pair; each half is a long below its radix."""
    def noise(i: Column, half: Column, radix: Column) -> Column:
        # 60 bits of the digest
        return F.pmod(F.conv(F.substring(_digest(key, kind, i, half), 1, 15), 16, 10).cast("long"), radix)

    sign = -1 if invert else 1
    rounds = [F.lit(i) for i in (reversed(range(ROUNDS)) if invert else range(ROUNDS))]

    def step(acc: Column, i: Column) -> Column:
        return F.when(
            i % 2 == 0,
            F.struct(F.pmod(acc["l"] + sign * noise(i, acc["r"], radix_left), radix_left).alias("l"),
                     acc["r"].alias("r"))
        ).otherwise(
            F.struct(acc["l"].alias("l"),
                     F.pmod(acc["r"] + sign * noise(i, acc["l"], radix_right), radix_right).alias("r")))

    return F.aggregate(F.array(*rounds), F.struct(left.cast("long").alias("l"),
                                                  right.cast("long").alias("r")), step)


def permuted_digits(digits: Column, key: Column, kind: str, invert: bool = False) -> Column:
    """Digits of the same number, 2 to 30 of them."""
    def permute(d: Column) -> Column:
        n = F.length(d)
        head = F.floor(n / 2).cast("int")
        ten = lambda k: F.pow(F.lit(10.0), k).cast("long")
        out = feistel(F.substr(d, F.lit(1), head).cast("long"), F.substr(d, head + 1, n - head).cast("long"),
                      ten(head), ten(n - head), key, kind, invert)
        return let(out, lambda p: F.concat(F.lpad(p["l"].cast("string"), head, F.lit("0")),
                                           F.lpad(p["r"].cast("string"), n - head, F.lit("0"))))
    return let(digits, permute)


def permuted_letters(letters: Column, key: Column, kind: str, invert: bool = False) -> Column:
    """Capitals of the same number, 26 at most, so that each half fits a long."""
    def number(part: Column) -> Column:
        return F.aggregate(F.filter(F.split(part, ""), lambda c: c != ""), F.lit(0).cast("long"),
                           lambda acc, c: acc * 26 + F.ascii(c) - 65)

    def written(value: Column, n: Column) -> Column:
        return F.aggregate(
            F.slice(F.sequence(F.lit(0), n), 1, n), F.struct(F.lit("").alias("out"), value.alias("rest")),
            lambda acc, _: F.struct(F.concat(F.char(65 + acc["rest"] % 26), acc["out"]).alias("out"),
                                    F.floor((acc["rest"] - acc["rest"] % 26) / 26).cast("long").alias("rest")),
            lambda acc: acc["out"])

    def permute(d: Column) -> Column:
        n = F.length(d)
        head = F.floor(n / 2).cast("int")
        size = lambda k: F.element_at(F.array(*[F.lit(26**i) for i in range(14)]), k + 1).cast("long")
        out = feistel(number(F.substr(d, F.lit(1), head)), number(F.substr(d, head + 1, n - head)),
                      size(head), size(n - head), key, kind, invert)
        return let(out, lambda p: F.concat(written(p["l"], head), written(p["r"], n - head)))
    return F.when(letters == "", letters).otherwise(let(letters, permute))


def _only_digits(found: Column) -> Column:
    return F.regexp_replace(found, r"\D", "")


def _in_format(found: Column, digits: Column, letters: Column | None = None) -> Column:
    """``found`` with its digits replaced one after the other, and its capitals if some are given."""
    letters = F.lit("") if letters is None else letters
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"), F.lit(1).alias("m"))

    def step(acc: Column, c: Column) -> Column:
        put = lambda x, k, m: F.struct(F.concat(acc["out"], x).alias("out"), (acc["k"] + k).alias("k"),
                                       (acc["m"] + m).alias("m"))
        return F.when(c.rlike(r"^\d$"), put(F.substr(digits, acc["k"], F.lit(1)), 1, 0)).when(
            c.rlike("^[A-Z]$") & (letters != ""), put(F.substr(letters, acc["m"], F.lit(1)), 0, 1)).otherwise(put(c, 0, 0))
    return F.aggregate(F.split(found, ""), start, step, lambda acc: acc["out"])


def _luhn_sum(digits: Column) -> Column:
    """Sum over all digits, with every second from the right doubled, the last one not."""
    def share(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 1, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), share), F.lit(0), lambda a, x: a + x)


def _mail(found: Column, key: Column, invert: bool) -> Column:
    plain = F.lower(found)
    return F.concat(F.lit("u"), F.substring(_digest(key, "mail", plain), 1, 12), F.lit("@d"),
                    F.substring(_digest(key, "host", F.substring_index(plain, "@", -1)), 1, 8),
                    F.lit(".example"))


def _secret(found: Column, key: Column, invert: bool) -> Column:
    digest = F.substr(_digest(key, "secret", F.lower(found)), F.lit(1), F.length(found))
    return F.when(found.rlike(r"\d") & found.rlike("[A-Fa-f]"),
                  F.when(found.rlike("[A-F]"), F.upper(digest)).otherwise(digest))


def _iban(found: Column, key: Column, invert: bool) -> Column:
    def remainder(bban: Column, country: Column, check: Column) -> Column:
        def value(acc: Column, c: Column) -> Column:
            code = F.ascii(c)
            return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)
        return F.aggregate(F.split(F.concat(bban, country, check), ""), F.lit(0), value)

    def change(bare: Column) -> Column:
        country, check, bban = F.substring(bare, 1, 2), F.substring(bare, 3, 2), F.substr(bare, F.lit(5))
        digits, letters = F.regexp_replace(bban, "[A-Z]", ""), F.regexp_replace(bban, r"\d", "")
        new = F.struct(permuted_digits(digits, key, "iban", invert).alias("digits"),
                       permuted_letters(letters, key, "iban letters", invert).alias("letters"))
        fits = F.length(digits).between(2, 30) & (F.length(letters) <= 26)
        renewed = let(new, lambda b: let(
            _in_format(bban, b["digits"], b["letters"]), lambda whole: F.struct(
                F.concat(F.lpad((98 - remainder(whole, country, F.lit("00"))).cast("string"), 2, "0"),
                         b["digits"]).alias("digits"),
                F.concat(country, b["letters"]).alias("letters"))))
        return F.when(fits & (F.length(bare) <= 34) & (remainder(bban, country, check) == 1), renewed)
    return let(F.regexp_replace(found, "[ -]", ""), lambda bare: let(
        change(bare), lambda d: F.when(d.isNotNull(), _in_format(found, d["digits"], d["letters"]))))


def _card(found: Column, key: Column, invert: bool) -> Column:
    def change(digits: Column) -> Column:
        inner = F.substr(digits, F.lit(2), F.length(digits) - 2)
        body = F.concat(F.substring(digits, 1, 1), permuted_digits(inner, key, "card", invert))
        whole = let(body, lambda b: F.concat(
            b, F.pmod(-_luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
        valid = (_luhn_sum(digits) % 10 == 0) & ~digits.rlike("^(.)\\1*$")
        return F.when(valid, let(whole, lambda d: _in_format(found, d)))
    return let(_only_digits(found), change)


def _phone(found: Column, key: Column, invert: bool) -> Column:
    def change(digits: Column) -> Column:
        code = F.when(found.rlike(f"^(?:{AREA_FIRST}|{NATIONAL})$"), F.length(digits) - 10).otherwise(
            F.length(F.regexp_extract(digits, COUNTRY_CODE, 0)))
        new = let(code, lambda n: F.concat(
            F.substr(digits, F.lit(1), n),
            permuted_digits(F.substr(digits, n + 1, F.length(digits) - n), key, "phone", invert)))
        return let(new, lambda d: _in_format(found, d))
    return let(_only_digits(found), change)


def _ssn(found: Column, key: Column, invert: bool) -> Column:
    def change(digits: Column) -> Column:
        area, group, serial = (F.substring(digits, at, n).cast("long") for at, n in ((1, 3), (4, 2), (6, 4)))
        valid = (area.between(1, 899)) & (area != 666) & (group > 0) & (serial > 0)
        out = feistel(area - F.when(area > 666, 2).otherwise(1), (group - 1) * 9999 + serial - 1,
                      F.lit(SSN_RADICES[0]), F.lit(SSN_RADICES[1]), key, "ssn", invert)
        pad = lambda v, n: F.lpad(v.cast("string"), n, "0")
        return F.when(valid, let(out, lambda p: F.concat_ws(
            "-", pad(p["l"] + F.when(p["l"] >= 665, 2).otherwise(1), 3),
            pad(F.floor(p["r"] / 9999) + 1, 2), pad(p["r"] % 9999 + 1, 4))))
    return let(_only_digits(found), change)


def _ip(found: Column, key: Column, invert: bool) -> Column:
    def change(parts: Column) -> Column:
        out = feistel(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], F.lit(65536), F.lit(65536),
                      key, "ip", invert)
        return F.when(F.forall(parts, lambda x: x < 256), let(out, lambda p: F.concat_ws(
            ".", *[v.cast("long").cast("string") for half in (p["l"], p["r"])
                   for v in (F.floor(half / 256), half % 256)])))
    return let(F.transform(F.split(found, r"\."), lambda x: x.cast("long")), change)


def _date(found: Column, key: Column, invert: bool) -> Column:
    def valid(y: Column, m: Column, d: Column) -> Column:
        leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
        last = F.when(m.isin(4, 6, 9, 11), 30).when((m == 2) & leap, 29).when(m == 2, 28).otherwise(31)
        return y.between(1900, 2099) & m.between(1, 12) & (d >= 1) & (d <= last)

    def change(parts: Column) -> Column:
        one, two, three = (parts[k].cast("int") for k in range(3))
        year_first, sep = F.length(parts[0]) == 4, F.regexp_extract(found, "[./-]", 0)
        short = F.exists(parts, lambda x: F.length(x) == 1)

        def shown(y: Column, m: Column, d: Column, order: str) -> Column:
            day = F.unix_date(F.make_date(y, m, d)) - FIRST_DAY
            out = feistel(F.floor(day / DATE_RADICES[1]), day % DATE_RADICES[1], F.lit(DATE_RADICES[0]),
                          F.lit(DATE_RADICES[1]), key, "date", invert)
            new = lambda p: F.date_from_unix_date(
                (p["l"] * DATE_RADICES[1] + p["r"] + FIRST_DAY).cast("int"))
            pad = lambda v: F.when(short, v.cast("string")).otherwise(F.lpad(v.cast("string"), 2, "0"))
            part = {"y": lambda n: F.year(n).cast("string"), "m": lambda n: pad(F.month(n)),
                    "d": lambda n: pad(F.day(n))}
            a, b, c = (part[x] for x in order)
            return let(let(out, new), lambda n: F.concat(a(n), sep, b(n), sep, c(n)))

        return F.when(year_first, F.when(valid(one, two, three), shown(one, two, three, "ymd"))).when(
            valid(three, two, one), shown(three, two, one, "dmy")).when(
            valid(three, one, two), shown(three, one, two, "mdy"))

    return let(F.split(found, "[./-]"), change)


CHANGES: dict[str, Callable[[Column, Column, bool], Column]] = {
    "mail": _mail, "iban": _iban, "card": _card, "phone": _phone, "ssn": _ssn, "ip": _ip,
    "date": _date, "secret": _secret}


def pseudonyms(text: Column, key: Column, invert: bool = False) -> Column:
    """Struct (text, kinds): the text with pseudonyms, and the kind of each in their order."""
    def change(found: Column) -> Column:
        chain = F
        for kind, pattern in KINDS.items():
            chain = chain.when(found.rlike(f"^(?:{pattern})$"), F.struct(
                CHANGES[kind](found, key, invert).alias("new"), F.lit(kind).alias("kind")))
        return let(chain, lambda c: F.struct(F.coalesce(c["new"], found).alias("new"),
                                             F.when(c["new"].isNotNull(), c["kind"]).alias("kind")))

    def whole(found: Column) -> Column:
        changed = F.transform(found, change)
        return let(changed, lambda rows: F.struct(
            F.array_join(F.zip_with(F.split(text, ANY, -1), rows,
                                    lambda piece, r: F.concat(piece, F.coalesce(r["new"], F.lit("")))),
                         "").alias("text"),
            F.filter(F.transform(rows, lambda r: r["kind"]), lambda k: k.isNotNull()).alias("kinds")))

    nothing = F.struct(text.alias("text"), F.array().cast("array<string>").alias("kinds"))
    # the quick look spares most texts the long pattern
    return F.when(text.rlike("[0-9@]"), let(
        F.regexp_extract_all(text, F.lit(ANY), F.lit(0)),
        lambda found: F.when(F.size(found) > 0, whole(found)).otherwise(nothing))).otherwise(nothing)


def pseudonymize(docs: DataFrame, key: str, text: str = "text", found: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and the kinds found in a new column if one is named."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    made = docs.select(row, pseudonyms(F.col(f"`{text}`"), F.lit(key)).alias("p"))
    columns = [(F.col("p.text") if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    return made.select(*columns, *([F.col("p.kinds").alias(found)] if found else []))
