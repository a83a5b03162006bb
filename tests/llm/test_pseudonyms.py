"""Pseudonyms: validity, permutation, undoing, linking, what is left alone."""

import datetime as dt
import hashlib
import ipaddress
import re

import regex
from pyspark.sql import functions as F

from sluiceway.llm import pseudonyms as p


def luhn(digits):
    return sum((v - 9 if v > 9 else v) for i, c in enumerate(reversed(digits)) for v in [int(c) * (1 + i % 2)]) % 10 == 0


def replaced(spark, texts, **options):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    return [r.text for r in p.pseudonymise(rows, "secret", **options).orderBy("id").collect()]


def test_every_permutation_is_one(spark):
    for a, b in ((1, 7), (10, 10), (3, 100), (17, 5)):
        got = spark.range(a * b).select(p.permute(F.col("id"), a, b, "s", "k").alias("y")).select(
            "y", p.permute(F.col("y"), a, b, "s", "k", backwards=True).alias("x"), F.monotonically_increasing_id()
        )
        assert sorted(r.y for r in got.collect()) == list(range(a * b))
        assert sorted(r.x for r in got.collect()) == list(range(a * b))


FORMS = {
    "4111 1111 1111 1111": lambda v: re.fullmatch(r"\d{4} \d{4} \d{4} \d{4}", v) and luhn(v.replace(" ", "")),
    "378282246310005": lambda v: len(v) == 15 and luhn(v),
    "192.168.0.1": lambda v: all(0 <= int(x) <= 255 for x in v.split(".")),
    "+1 (212) 555-0187": lambda v: re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", v),
    "123-45-6789": lambda v: re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}", v),
    "1988-02-29": dt.date.fromisoformat,
    "31/12/1999": lambda v: dt.datetime.strptime(v, "%d/%m/%Y"),
    "05.06.2007": lambda v: dt.datetime.strptime(v, "%d.%m.%Y"),
    "+44 20 7946 0958": lambda v: re.fullmatch(r"\+44 \d\d \d{4} \d{4}", v),
    "+49 (89) 12345678": lambda v: re.fullmatch(r"\+49 \(\d\d\) \d{8}", v),
    "DE89370400440532013000": lambda v: re.fullmatch(r"DE\d{20}", v) and iban(v),
    "GB82 WEST 1234 5698 7654 32": lambda v: re.fullmatch(r"GB\d\d WEST \d{4} \d{4} \d{4} \d\d", v) and iban(v),
    "2001:0db8:0000:0000:0000:0000:0000:0001": ipaddress.IPv6Address,
}


def iban(v):
    v = v.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def test_forms_stay_valid_and_can_be_undone(spark):
    texts = [f"a {v}; b [{v}] {v}" for v in FORMS]
    new = replaced(spark, texts)
    for (value, valid), text in zip(FORMS.items(), new):
        found = re.fullmatch(r"a (.+); b \[(.+)\] (.+)", text).groups()
        assert len(set(found)) == 1 and found[0] != value and valid(found[0])
    assert replaced(spark, new, backwards=True) == texts


def test_tokens_keep_their_form(spark):
    tokens = ["token = \"e7fbfec6a80404dc513b99d3fdbf2a6e53400638\"", "TOKEN: 9233A8ECF7C5B09FE5949719B6B82BC4", "sha e7fbfec6a80404dc513b99d3fdbf2a6e53400638"]
    new = replaced(spark, tokens)
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', new[0]) and re.fullmatch(r"TOKEN: [0-9A-F]{32}", new[1])
    assert new[0] != tokens[0] and new[1] != tokens[1] and new[2] == tokens[2]
    assert replaced(spark, new, backwards=True) == tokens


def test_addresses_link_however_they_are_shortened(spark):
    new = replaced(spark, ["at 2001:db8::1.", "2001:0DB8:0:0:0:0:0:1", "fe80:1::", "::1 std::vector a::b 12:30:45 x", "1:2:3:4:5:6:7:8:9"])
    assert new[0] == f"at {new[1]}." and ipaddress.IPv6Address(new[1]) and ipaddress.IPv6Address(new[2]) != ipaddress.IPv6Address("fe80:1::")
    assert new[3:] == ["::1 std::vector a::b 12:30:45 x", "1:2:3:4:5:6:7:8:9"]


def test_invalid_numbers_stay(spark):
    texts = ["DE88370400440532013000", "AB12 TEST 1234", "+1234567", "+12 3456789012345678", "12/31/2021"]
    assert replaced(spark, texts) == texts


def test_tokens_with_a_common_start_are_not_linked(spark):
    start = "0123456789"
    one, two = replaced(spark, [f"token={start}{'a' * 30}", f"token={start}{'b' * 30}"])
    assert one[6:10] != two[6:10] and one[-4:] != two[-4:]


def strings(text, base, secret, kind):
    """Feistel over the two halves of a string, digit by digit."""
    at = len(text) // 2
    left, right = text[:at], text[at:]
    for i in range(p.ROUNDS):
        half, other = (left, right) if i % 2 == 0 else (right, left)
        by = hashlib.sha256(f"{secret}|{kind}|{i}|{len(half)}|{other}".encode()).hexdigest()
        new = "".join(f"{(int(x, 16) + int(y, 16)) % base:x}" for x, y in zip(half, by))
        left, right = (new, right) if i % 2 == 0 else (left, new)
    return left + right


def numbers(x, a, b, secret, kind):
    left, right = divmod(x, b)
    for i in range(p.ROUNDS):
        by = int(hashlib.sha256(f"{secret}|{kind}|{i}|{right if i % 2 == 0 else left}".encode()).hexdigest()[:13], 16)
        left, right = ((left + by) % a, right) if i % 2 == 0 else (left, (right + by) % b)
    return left * b + right


def put(value, digits):
    it = iter(digits)
    return re.sub(r"[0-9]", lambda _: next(it), value)


def card(groups, marks, secret):
    """Usual groupings first, then the longest valid row of groups from each on."""
    usual = {"-".join(map(str, shape)) for shape in [map(int, g.split("-")) for g in p.GROUPINGS]}

    def known(i):
        if 13 <= len(groups[i]) <= 19 and luhn(groups[i]):
            return 1
        for shape in p.GROUPINGS:
            n = shape.count("-") + 1
            if "-".join(str(len(g)) for g in groups[i : i + n]) == shape and shape in usual and luhn("".join(groups[i : i + n])):
                return n
        return 0

    fixed = [known(i) for i in range(len(groups))]
    out, at, n_cards = "", 0, 0
    while at < len(groups):
        n = fixed[at]
        if not n:
            size = 0
            while at + n < len(groups) and n < 19 and not fixed[at + n] and size + len(groups[at + n]) <= 19:
                size += len(groups[at + n])
                n += 1
            n = n if size >= 13 and luhn("".join(groups[at : at + n])) else 0
        span = max(1, n)
        text = "".join(g + m for g, m in zip(groups[at : at + span], marks[at : at + span]))
        text, tail = text[: len(text) - len(marks[at + span - 1])], marks[at + span - 1]
        if n:
            n_cards += 1
            digits = re.sub(r"[^0-9]", "", text)
            m = len(digits) - 1
            body = str(numbers(int(digits[:-1]), 10 ** (m - m // 2), 10 ** (m // 2), secret, f"card{len(digits)}")).zfill(m)
            check = next(c for c in "0123456789" if luhn(body + c))
            text = put(text, body + check)
        out += text + tail
        at += span
    return (out if n_cards else None), n_cards


def one(kind, v, secret):
    digits = re.sub(r"[^0-9]", "", v)
    if kind == "email":
        return "u" + hashlib.sha256(f"{secret}|email|{v.lower()}".encode()).hexdigest()[:16] + "@" + v.split("@")[1]
    if kind == "ipv4":
        try:
            x = int(ipaddress.IPv4Address(v))
        except ValueError:
            return None
        return str(ipaddress.IPv4Address(numbers(x, 65536, 65536, secret, kind)))
    if kind == "phone":
        return put(v, digits[:-10] + str(numbers(int(digits[-10:]), 10**5, 10**5, secret, kind)).zfill(10))
    if kind == "ssn":
        area, group, serial = map(int, v.split("-"))
        if not (0 < area < 900 and area != 666 and group and serial):
            return None
        y = numbers(((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, secret, kind)
        place, s = divmod(y, 9999)
        a = place // 99 + 1
        return f"{a + (a >= 666):03d}-{place % 99 + 1:02d}-{s + 1:04d}"
    if kind == "date":
        form = "%Y-%m-%d" if v[2].isdigit() else "%d/%m/%Y" if "/" in v else "%d.%m.%Y"
        try:
            x = (dt.datetime.strptime(v, form).date() - dt.date(1900, 1, 1)).days
        except ValueError:
            return None
        new = dt.date(1900, 1, 1) + dt.timedelta(days=numbers(x, 250, 292, secret, kind)) if 0 <= x < p.DAYS else None
        return new and new.strftime(form)
    if kind == "secret":
        new = strings(v.lower(), 16, secret, kind)
        return new.upper() if v == v.upper() else new
    raise AssertionError(kind)


def plain(text, secret):
    """Whole texts, value by value, with hashlib and the same forms."""
    out, at, kinds = [], 0, []
    for m in regex.finditer(p.PATTERN, text or "", flags=regex.ASCII):
        v = m.group()
        kind = next(k for k in p.KINDS if regex.fullmatch("[0-9A-Fa-f]{32,64}" if k == "secret" else p._FORMS[k], v, flags=regex.ASCII))
        if kind == "card":
            new, n = card(re.findall(r"[0-9]+", v), [*re.findall(r"[ -]", v), ""], secret)
        else:
            new, n = one(kind, v, secret), 1
        out += [text[at : m.start()], v if new is None else new]
        kinds += [kind] * n if new is not None else []
        at = m.end()
    return "".join([*out, (text or "")[at:]]), kinds


def test_whole_table_against_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: (r.text, r.pii_kinds) for r in p.pseudonymise(docs, "secret").collect()}
    want = {r.doc_id: plain(r.text, "secret") for r in docs.collect()}
    assert {k: v for k, v in got.items() if v != want[k]} == {}
    assert len({k for _, kinds in want.values() for k in kinds}) >= 5


def test_different_values_stay_different(spark):
    texts = [f"10.0.{i // 256}.{i % 256}" for i in range(600)]
    assert len(set(replaced(spark, texts))) == 600


def test_addresses_keep_their_domain(spark):
    a, b, c = replaced(spark, ["to: jo.81@mail7.example.com.", "jo.81@mail7.example.com", "al@x.org"])
    assert a == f"to: {b}." and b.endswith("@mail7.example.com") and "jo" not in b.split("@")[0] and c.endswith("@x.org")


def test_what_is_no_personal_value_stays(spark):
    texts = ["4111 1111 1111 1112", "300.1.1.1", "1.02.3.4", "000-12-3456", "1987-02-29", "v1.2.3.4.5", "12345", "@home", "", None, "1850-01-01"]
    assert replaced(spark, texts) == texts


def test_cards_beside_other_digits(spark):
    card, other, ip, date = "4111111111111111", "378282246310005", "190.137.223.204", "2024-01-05"
    grouped = lambda v: " ".join(v[i : i + 4] for i in range(0, 16, 4))

    def cases(c, o, ip, date):
        return [
            c, o, ip, date, f"{c} {ip}", f"{c}-{ip}", f"{c} {date}", f"{grouped(c)} 12/27", f"{c} 123", f"order 12 {c}", f"order 12-{c}",
            f"{grouped(c)} 99 7-{o} 1", f"{o[:4]}-{o[4:10]}-{o[10:]} {c}", f"{c} {o}",
        ]

    old = cases(card, other, ip, date)
    rows = spark.createDataFrame(list(enumerate([*old, "41111 11111 111111", " ".join(["7"] * 3000)])), "id int, text string")
    out = p.pseudonymise(rows, "secret").orderBy("id").collect()
    new = [r.text for r in out]
    assert new[: len(old)] == cases(*new[:4]) and not set(new[:4]) & set(old)
    assert out[len(old) - 1].pii_kinds == ["card", "card"]
    assert re.fullmatch(r"\d{5} \d{5} \d{6}", new[-2]) and new[-2] != "41111 11111 111111" and len(new[-1]) == 5999
    assert replaced(spark, new[: len(old)], backwards=True) == old


def test_odd_rows(odd):
    out = p.pseudonymise(odd, "secret")
    assert out.count() == odd.count() and set(out.columns) >= {c for c in odd.columns if c not in ("_found", "_once")}
    assert {len(r.text or "") for r in out.collect()} == {len(r.text or "") for r in odd.collect()}
    assert p.pseudonymise(odd.limit(0), "secret").count() == 0
