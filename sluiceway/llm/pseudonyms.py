"""Format-preserving pseudonyms for personal numbers and dates, by keyed Feistel permutations.

A value is recognised by its form and validated (checksum, ranges, calendar). Its digits are taken as a number
x below A * B and split into (x div B, x mod B). Alternating rounds add a keyed hash of one half to the other,
modulo A or B. That is a permutation of the numbers below A * B for any A and B, so the result has the same
form, is again valid, differs for different values, and can be undone with the key. Equal values of a kind
become equal pseudonyms in all documents, whatever their punctuation.

Kinds: payment cards (13 to 19 digits, Luhn; the check digit is computed anew; see _cards for cards beside other
digits), telephone numbers
(+CC and ten digits, or + and 8 to 15 digits in other groupings), international account numbers (modulo 97; the check
digits are computed anew), social security numbers (ddd-dd-dddd in valid ranges), IPv4 and IPv6 addresses, dates
(yyyy-mm-dd, dd/mm/yyyy, dd.mm.yyyy within FIRST_DAY .. FIRST_DAY + DAYS; month-first dates stay, since a reader
cannot tell which of them are), access tokens (32 to 64 hexadecimal
digits after a word such as token or secret, permuted as a whole), and the local part of e-mail
addresses, which is not a number: it becomes a keyed name of 16 hexadecimal digits.

Everything is built from column functions; nothing is shuffled.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import let, once

ROUNDS = 10
#: Dates are permuted within this range; others are left alone. DAYS factors into 250 * 292.
FIRST_DAY, DAYS = "1900-01-01", 73_000
KINDS = ("email", "ipv4", "ipv6", "iban", "phone", "ssn", "date", "secret", "card", "world")
#: Country codes of two digits. 1 and 7 have one; all others have three.
TWO_DIGIT_CODES = (
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"
).split()

_FORMS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+\-]*@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}",
    "ipv4": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)",
    "ipv6": r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![\w:]|\.\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2} ?[A-Z0-9]{4}(?: ?(?=[A-Z]{0,3}\d)[A-Z0-9]{4}){1,6}(?: ?(?=[A-Z]{0,2}\d)[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "phone": r"(?<![\d+])\+\d{1,3}[ .\-]?\(?\d{3}\)?[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "date": r"(?<![\d./\-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d/\-])",
    "secret": r"(?<=(?i:token|secret|apikey|api_key|password)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)"
    r"(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z])",
}
# A run of digit groups with one space or hyphen between; it ends before a value of another kind.
_GROUP = r"\d++(?!-(?!\d))"
_OTHER = "|".join(_FORMS[k] for k in ("ipv4", "ssn", "date"))
_FORMS["world"] = r"(?<![\d+])\+\d{1,3}(?:[ .\-]?\(?\d{1,5}\)?){1,6}(?!\d)"
_FORMS["card"] = rf"(?<![\d\-.])(?=\d(?:[ \-]?\d){{12}}){_GROUP}(?:[ \-](?!{_OTHER}){_GROUP})*+"
#: Usual sizes of the digit groups of cards besides one unbroken run, in order of preference.
GROUPINGS = ("4-4-4-4", "4-6-5", "4-6-4", "4-4-5", "4-3-3-3", "4-4-4-4-3", "6-13")
#: One pattern for all kinds; the first alternative that matches at a place decides.
PATTERN = "(" + "|".join(f"(?:{_FORMS[k]})" for k in KINDS) + ")"


def _hash(secret: str, kind: str, step: Column | int, half: Column) -> Column:
    """52 bits of a keyed hash."""
    step = F.lit(step) if isinstance(step, int) else step
    digest = F.sha2(F.concat_ws("|", F.lit(secret), F.lit(kind), step.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def permute(x: Column, a: int, b: int, secret: str, kind: str, backwards: bool = False) -> Column:
    """The keyed permutation of the numbers 0 <= x < a * b."""
    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if backwards else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    sign = -1 if backwards else 1

    def turn(s: Column, i: Column) -> Column:
        left = F.when(i % 2 == 0, F.pmod(s["l"] + sign * _hash(secret, kind, i, s["r"]), F.lit(a))).otherwise(s["l"])
        right = F.when(i % 2 == 1, F.pmod(s["r"] + sign * _hash(secret, kind, i, s["l"]), F.lit(b))).otherwise(s["r"])
        return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    start = F.struct(F.floor(x / F.lit(b)).cast("long").alias("l"), F.pmod(x, F.lit(b)).cast("long").alias("r"))
    return let(F.aggregate(rounds, start, turn), lambda s: s["l"] * F.lit(b) + s["r"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _pad(x: Column, n: int) -> Column:
    return F.lpad(x.cast("string"), n, "0")


def _put(value: Column, digits: Column) -> Column:
    """Write new digits into the places of the old ones, keeping punctuation."""
    marks = F.split(value, "")
    step = F.aggregate(
        marks,
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(
            c.rlike(r"^\d$"),
            F.struct(F.concat(s["out"], F.substr(digits, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at")),
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
    )
    return step["out"]


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum: every second digit from the right, from the second on, counts double with its digits added."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: let(c.cast("int") * (1 + i % 2), lambda d: F.when(d > 9, d - 9).otherwise(d)))
    return F.aggregate(each, F.lit(0), lambda total, d: total + d)


def _permute_text(digits: Column, n: int, secret: str, kind: str, backwards: bool) -> Column:
    """n digits as text, up to 18, to n others."""
    low = n // 2
    return _pad(permute(digits.cast("long"), 10 ** (n - low), 10**low, secret, kind, backwards), n)


def _card(value: Column, secret: str, backwards: bool) -> Column:
    def of(digits: Column) -> Column:
        branches = [
            F.when(F.length(digits) == n, _permute_text(F.substring(digits, 1, n - 1), n - 1, secret, f"card{n}", backwards))
            for n in range(13, 20)
        ]
        whole = let(F.coalesce(*branches), lambda body: F.concat(body, F.pmod(-luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")))
        return F.when(luhn_sum(digits) % 10 == 0, _put(value, whole))

    return let(_digits(value), of)


def _cards(value: Column, secret: str, backwards: bool) -> Column:
    """Struct ``new, n``: a run of digit groups with its n cards replaced; new is null if there are none.

    An unbroken run of 13 to 19 digits or one of the usual groupings is a card if it is valid, wherever it begins.
    Elsewhere the longest row of groups up to 19 digits is tried from each group on, from left to right. If an invalid
    reading overlaps the card that was found, the pseudonym may make it valid by chance; then that one is not undone.
    """

    def valid(digits: Column) -> Column:
        return luhn_sum(digits) % 10 == 0

    def of(s: Column) -> Column:
        groups, marks = s["groups"], s["marks"]
        at = F.sequence(F.lit(1), F.size(groups))
        joined = lambda i, n: F.array_join(F.slice(groups, i, F.lit(n) if isinstance(n, int) else n), "")

        def usual(i: Column) -> Column:
            forms = F.array(*[F.struct(F.lit(f).alias("form"), F.lit(f.count("-") + 1).alias("n")) for f in ("", *GROUPINGS)])
            sizes = lambda n: F.array_join(F.transform(F.slice(groups, i, n), lambda g: F.length(g).cast("string")), "-")
            shaped = lambda f: F.when(f["form"] == "", F.length(F.get(groups, i - 1)).between(13, 19)).otherwise(sizes(f["n"]) == f["form"])
            fit = F.filter(forms, lambda f: F.when(shaped(f), valid(joined(i, f["n"]))).otherwise(F.lit(False)))
            return F.coalesce(F.get(fit, F.lit(0))["n"], F.lit(0))

        def walk(known: Column) -> Column:
            def longest(i: Column) -> Column:
                """How many groups from i on hold at most 19 digits and no known card."""
                ahead = F.zip_with(F.slice(groups, i, 19), F.slice(known, i, 19), lambda g, k: F.struct(F.length(g).alias("g"), k.alias("k")))
                start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("sum"))
                more = lambda t, x: F.when(
                    (t["sum"] >= 0) & (x["k"] == 0) & (t["sum"] + x["g"] <= 19),
                    F.struct((t["n"] + 1).alias("n"), (t["sum"] + x["g"]).alias("sum")),
                ).otherwise(F.struct(t["n"].alias("n"), F.lit(-1).alias("sum")))
                return F.aggregate(ahead, start, more)["n"]

            def free(i: Column) -> Column:
                return let(longest(i), lambda n: let(joined(i, n), lambda d: F.when((F.length(d) >= 13) & valid(d), n).otherwise(F.lit(0))))

            def step(t: Column, i: Column) -> Column:
                taken = let(F.when(F.get(known, i - 1) > 0, F.get(known, i - 1)).otherwise(free(i)), lambda n: F.struct(
                    F.array_append(t["spans"], F.struct(i.alias("at"), F.greatest(n, F.lit(1)).alias("n"), (n > 0).alias("card"))).alias("spans"),
                    (i + F.greatest(n, F.lit(1))).alias("next"),
                ))
                return F.when(i < t["next"], t).otherwise(taken)

            none = F.array().cast("array<struct<at:int,n:int,card:boolean>>")
            return F.aggregate(at, F.struct(none.alias("spans"), F.lit(1).alias("next")), step)["spans"]

        def text(span: Column) -> Column:
            """The groups of a span with the marks between them."""
            inner = F.zip_with(F.slice(groups, span["at"], span["n"]), F.slice(marks, span["at"], span["n"]), lambda g, m: F.concat(g, m))
            return F.rtrim(F.array_join(inner, ""), F.lit(" -"))

        def write(spans: Column) -> Column:
            piece = lambda p: F.concat(
                F.when(p["card"], _card(text(p), secret, backwards)).otherwise(text(p)),
                F.get(marks, p["at"] + p["n"] - 2),
            )
            n = F.size(F.filter(spans, lambda p: p["card"]))
            return F.struct(F.when(n > 0, F.array_join(F.transform(spans, piece), "")).alias("new"), n.alias("n"))

        return let(let(F.transform(at, usual), walk), write)

    groups = F.regexp_extract_all(value, F.lit(r"(\d+)"), 1)
    marks = F.concat(F.regexp_extract_all(value, F.lit(r"([ \-])"), 1), F.array(F.lit("")))
    return let(F.struct(groups.alias("groups"), marks.alias("marks")), of)


def _phone(value: Column, secret: str, backwards: bool) -> Column:
    def of(digits: Column) -> Column:
        country = F.substr(digits, F.lit(1), F.length(digits) - 10)
        return _put(value, F.concat(country, _permute_text(F.right(digits, F.lit(10)), 10, secret, "phone", backwards)))

    return let(_digits(value), of)


def _ssn(value: Column, secret: str, backwards: bool) -> Column:
    area, group, serial = (F.split(value, "-")[i].cast("int") for i in range(3))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    number = (area - 1 - (area > 666).cast("int")) * 99 + group - 1  # 898 areas of 99 groups
    x = number.cast("long") * 9999 + serial - 1

    def back(y: Column) -> Column:
        place = F.floor(y / 9999)
        area_at = F.floor(place / 99) + 1
        return F.concat_ws(
            "-", _pad(area_at + (area_at >= 666).cast("int"), 3), _pad(place % 99 + 1, 2), _pad(y % 9999 + 1, 4)
        )

    return F.when(valid, let(permute(x, 898 * 99, 9999, secret, "ssn", backwards), back))


def _ipv4(value: Column, secret: str, backwards: bool) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("long"))
    x = F.aggregate(parts, F.lit(0).cast("long"), lambda t, p: t * 256 + p)
    # A part with a leading zero is no address, but, say, a version.
    valid = F.forall(parts, lambda p: p < 256) & ~value.rlike(r"(^|\.)0\d")
    back = lambda y: F.concat_ws(".", *[(F.floor(y / 256**i) % 256).cast("string") for i in (3, 2, 1, 0)])
    return F.when(valid, let(permute(x, 65536, 65536, secret, "ipv4", backwards), back))


def _date(value: Column, secret: str, backwards: bool) -> Column:
    iso = value.rlike(r"^\d{4}")
    day = F.coalesce(
        F.when(iso, F.try_to_date(value, "yyyy-MM-dd")),
        F.when(value.contains("/"), F.try_to_date(value, "dd/MM/yyyy")),
        F.when(~iso & value.contains("."), F.try_to_date(value, "dd.MM.yyyy")),
    )
    x = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")

    def back(y: Column) -> Column:
        new = F.date_add(F.lit(FIRST_DAY).cast("date"), y.cast("int"))
        return (
            F.when(iso, F.date_format(new, "yyyy-MM-dd"))
            .when(value.contains("/"), F.date_format(new, "dd/MM/yyyy"))
            .otherwise(F.date_format(new, "dd.MM.yyyy"))
        )

    return F.when((x >= 0) & (x < DAYS), let(permute(x, 250, 292, secret, "date", backwards), back))


def _email(value: Column, secret: str) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(secret), F.lit("email"), F.lower(value)), 256)
    return F.concat(F.lit("u"), F.substring(digest, 1, 16), F.lit("@"), F.split(value, "@")[1])


_NIBBLES = "0123456789abcdef"


def permute_string(text: Column, base: int, secret: str, kind: str, backwards: bool = False) -> Column:
    """The keyed permutation of strings of one length over the first ``base`` of the digits 0-9a-f, up to 64 of them.

    A Feistel network over the two halves of the string: a keyed hash of one half is added to the other, digit by digit, so
    every digit of the result depends on every digit of the string.
    """
    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if backwards else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    digit = lambda c: F.instr(F.lit(_NIBBLES), c) - 1
    sign = -1 if backwards else 1

    def mixed(half: Column, other: Column, i: Column) -> Column:
        by = F.sha2(F.concat_ws("|", F.lit(secret), F.lit(kind), i.cast("string"), F.length(half).cast("string"), other), 256)
        added = F.zip_with(
            F.split(half, ""),
            F.split(F.substr(by, F.lit(1), F.length(half)), ""),
            lambda x, y: F.substr(F.lit(_NIBBLES), F.pmod(digit(x) + sign * digit(y), F.lit(base)) + 1, F.lit(1)),
        )
        return F.array_join(added, "")

    def turn(s: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.struct(mixed(s["l"], s["r"], i).alias("l"), s["r"].alias("r"))).otherwise(
            F.struct(s["l"].alias("l"), mixed(s["r"], s["l"], i).alias("r"))
        )

    def of(t: Column) -> Column:
        half = F.floor(F.length(t) / 2).cast("int")
        start = F.struct(F.substr(t, F.lit(1), half).alias("l"), F.substr(t, half + 1, F.length(t)).alias("r"))
        return let(F.aggregate(rounds, start, turn), lambda s: F.concat(s["l"], s["r"]))

    return let(text, of)


def _secret(value: Column, secret: str, backwards: bool) -> Column:
    new = permute_string(F.lower(value), 16, secret, "secret", backwards)
    return let(new, lambda n: F.when(value == F.upper(value), F.upper(n)).otherwise(n))


def _world_phone(value: Column, secret: str, backwards: bool) -> Column:
    """Numbers in national groupings: 8 to 15 digits, of which the country code stays."""

    def of(digits: Column) -> Column:
        code = F.when(digits.rlike("^[17]"), 1).when(F.substring(digits, 1, 2).isin(*TWO_DIGIT_CODES), 2).otherwise(3)
        rest = let(code, lambda c: F.concat(F.substr(digits, F.lit(1), c), permute_string(F.substr(digits, c + 1, F.length(digits)), 10, secret, "phone", backwards)))
        return F.when(F.length(digits).between(8, 15), _put(value, rest))

    return let(_digits(value), of)


def _iban(value: Column, secret: str, backwards: bool) -> Column:
    """International account numbers: digits of the account are permuted, country and letters stay, the check is computed anew."""

    def remainder(text: Column) -> Column:
        """Modulo 97, letters as two digits."""
        return F.aggregate(
            F.split(text, ""),
            F.lit(0),
            lambda t, c: F.when(c.rlike("[0-9]"), t * 10 + c.try_cast("int")).otherwise(t * 100 + F.ascii(c) - 55) % 97,
        )

    def of(plain: Column) -> Column:
        country, account = F.substring(plain, 1, 2), F.substr(plain, F.lit(5), F.length(plain))
        new = let(account, lambda a: _put(a, permute_string(_digits(a), 10, secret, "iban", backwards)))
        whole = let(new, lambda n: F.concat(country, _pad(98 - remainder(F.concat(n, country, F.lit("00"))), 2), n))
        valid = remainder(F.concat(account, F.substring(plain, 1, 4))) == 1
        spaced = F.when(value.contains(" "), F.trim(F.regexp_replace(whole, "(.{4})", "$1 "))).otherwise(whole)
        # Groups of four with a space between, or none at all, are how such numbers are written.
        usual = (~value.contains(" ")) | value.rlike("^[A-Z]{2}[0-9]{2}( [A-Z0-9]{4})+( [A-Z0-9]{1,3})?$")
        return F.when(valid & usual & (F.length(plain).between(15, 34)), spaced)

    return let(F.replace(value, F.lit(" "), F.lit("")), of)


def _ipv6(value: Column, secret: str, backwards: bool) -> Column:
    """Addresses of eight groups; the pseudonym is written in full. Equal addresses link, however they are shortened."""

    def of(sides: Column) -> Column:
        groups = lambda s: F.filter(F.split(s, ":"), lambda g: g != "")
        left, right = groups(F.get(sides, F.lit(0))), groups(F.coalesce(F.get(sides, F.lit(1)), F.lit("")))
        gap = F.array_repeat(F.lit("0"), F.lit(8) - F.size(left) - F.size(right))
        whole = F.transform(F.concat(left, gap, right), lambda g: F.lpad(F.lower(g), 4, "0"))
        new = permute_string(F.array_join(whole, ""), 16, secret, "ipv6", backwards)
        valid = value.rlike(r"\d") & (F.size(left) + F.size(right)).between(2, 8)
        return F.when(valid, let(new, lambda n: F.array_join(F.regexp_extract_all(n, F.lit("(.{4})"), 1), ":")))

    return let(F.split(value, "::"), of)


def _kind(value: Column) -> Column:
    """The kind whose form a match has as a whole; what stood before a token is not part of the match."""
    alone = _FORMS | {"secret": "[0-9A-Fa-f]{32,64}"}
    whole = [F.when(value.rlike(f"^(?:{alone[k]})$"), F.lit(k)) for k in KINDS]
    return F.coalesce(*whole)


def pseudonym(value: Column, secret: str, backwards: bool = False) -> Column:
    """Struct ``kind, new, n`` of one matched value; new is null if the value is not valid. n is 1, or the number of cards.

    Backwards gives the original again, except for e-mail addresses, which stay as they are.
    """
    by_kind: dict[str, Callable[[Column], Column]] = {
        "email": lambda v: F.lit(None).cast("string") if backwards else _email(v, secret),
        "ipv4": lambda v: _ipv4(v, secret, backwards),
        "ipv6": lambda v: _ipv6(v, secret, backwards),
        "iban": lambda v: _iban(v, secret, backwards),
        "phone": lambda v: _phone(v, secret, backwards),
        "world": lambda v: _world_phone(v, secret, backwards),
        "ssn": lambda v: _ssn(v, secret, backwards),
        "date": lambda v: _date(v, secret, backwards),
        "secret": lambda v: _secret(v, secret, backwards),
    }

    def of(s: Column) -> Column:
        new = functools.reduce(
            lambda done, k: done.when(s["k"] == k, by_kind[k](s["v"])), list(by_kind)[1:], F.when(s["k"] == KINDS[0], by_kind[KINDS[0]](s["v"]))
        )
        one = F.struct(new.alias("new"), F.lit(1).alias("n"))
        return let(
            F.when(s["k"] == "card", _cards(s["v"], secret, backwards)).otherwise(one),
            lambda r: F.struct(F.when(s["k"] == "world", "phone").otherwise(s["k"]).alias("kind"), r["new"].alias("new"), r["n"].alias("n")),
        )

    return let(F.struct(_kind(value).alias("k"), value.alias("v")), of)


def pseudonymise(
    docs: DataFrame, secret: str, text: str = "text", backwards: bool = False, kinds: str = "pii_kinds"
) -> DataFrame:
    """Replace personal values in ``text`` and add ``kinds``: the kind of every replaced value, in order.

    All other columns and rows stay. Null texts stay null, texts without such values stay as they are; both
    have no kinds. A column of that name in the input is replaced; columns named _found, _new or _once are left out. Whoever has ``secret`` can undo the
    numbers and dates; keep it out of the data.
    """
    body = F.col(f"`{text}`")
    # Each text is searched once for its values and once more, only where it has any, for the gaps between them.
    found = F.when(body.rlike(r"[@\d]"), F.regexp_extract_all(body, F.lit(PATTERN), 1)).otherwise(F.array().cast("array<string>"))
    searched = once(docs.drop(kinds, "_found", "_new").withColumn("_found", F.coalesce(found, F.array().cast("array<string>"))))
    new = searched.withColumn("_new", F.transform("_found", lambda v: pseudonym(v, secret, backwards)))
    gaps = F.split(body, PATTERN, -1)
    pieces = F.zip_with(gaps, F.arrays_zip(F.col("_found").alias("old"), F.col("_new").alias("p")), lambda g, m: F.concat(g, F.coalesce(m["p"]["new"], m["old"], F.lit(""))))
    replaced = F.when(F.exists("_new", lambda p: p["new"].isNotNull()), F.array_join(pieces, "")).otherwise(body)
    return new.withColumns(
        {text: replaced, kinds: F.flatten(F.transform(F.filter("_new", lambda p: p["new"].isNotNull()), lambda p: F.array_repeat(p["kind"], p["n"])))}
    ).drop("_found", "_new", "_once")
