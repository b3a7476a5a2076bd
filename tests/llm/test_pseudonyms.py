import hashlib
import ipaddress
import re
from datetime import date, timedelta

import pytest

from perilgrid.llm.pseudonyms import KINDS, PATTERN, pseudonymize
from tests.llm.conftest import rows_of

KEY = "k'1\\"


def digest(kind, *values):
    return hashlib.sha512("|".join([KEY, kind, *map(str, values)]).encode()).hexdigest()


def shifted(kind, half, other, i):
    g, out = digest(kind, i, other), ""
    for j, c in enumerate(half):
        k = int(g[3 * (j % 42) : 3 * (j % 42) + 3].ljust(3, "0")[:3], 16)
        for low, size in (("0", 10), ("a", 26), ("A", 26)):
            if ord(low) <= ord(c) < ord(low) + size:
                c = chr(ord(low) + (ord(c) - ord(low) + k) % size)
                break
        out += c
    return out


def permuted(kind, text):
    a, b = text[: len(text) // 2], text[len(text) // 2 :]
    for i in range(1, 9):
        if i % 2 == 0:
            a = shifted(kind, a, b, i)
        else:
            b = shifted(kind, b, a, i)
    return a + b


def number(kind, *values):
    return int(digest(kind, *values)[:12], 16)


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def ip(text):
    n = int(ipaddress.ip_address(text))
    a, b = n >> 16, n & 65535
    for i in range(1, 9):
        a, b = b, a ^ number("ip", i, b) % 65536
    return str(ipaddress.ip_address(a << 16 | b))


def mixed_day(y):
    a, b = divmod(y % 146097, 773)
    for i in range(1, 9):
        if i % 2 == 0:
            a = (a + number("date", i, b)) % 189
        else:
            b = (b + number("date", i, a)) % 773
    return y - y % 146097 + a * 773 + b


def day(value):
    zero = date(1800, 1, 1)
    y = mixed_day((value - zero).days)
    while True:
        if date.min <= zero + timedelta(days=min(y, 2_900_000)) and y <= (date.max - zero).days:
            out = zero + timedelta(days=y)
            if (out.day > 12) == (value.day > 12):
                return out
        y = mixed_day(y)


def ssn(text):
    ok = re.compile(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}")
    text = permuted("ssn", text)
    while not ok.fullmatch(text):
        text = permuted("ssn", text)
    return text


def card(text):
    digits = re.sub(r"\D", "", text)
    head = digits[0] + permuted("card", digits[1:-1])
    whole = iter(head + next(c for c in "0123456789" if luhn(head + c)))
    return "".join(next(whole) if c.isdigit() else c for c in text)


def one(spark, docs, text):
    return pseudonymize(docs([(1, text)]), KEY).first()


CASES = {
    "email": [("bob.smith99@example.com", lambda t: permuted("email", "bob.smith99") + "@example.com")],
    "ip": [("10.2.3.44", ip), ("255.255.255.255", ip)],
    "date": [
        ("1984-02-29", lambda t: day(date(1984, 2, 29)).isoformat()),
        ("29/02/1984", lambda t: day(date(1984, 2, 29)).strftime("%d/%m/") + str(day(date(1984, 2, 29)).year)),
        ("02/28/1985", lambda t: day(date(1985, 2, 28)).strftime("%m/%d/") + str(day(date(1985, 2, 28)).year)),
        ("28.02.1985", lambda t: day(date(1985, 2, 28)).strftime("%d.%m.") + str(day(date(1985, 2, 28)).year)),
    ],
    "ssn": [("123-45-6789", ssn)],
    "phone": [("+1 (017) 555-7713", lambda t: "+1 " + permuted("phone", "(017) 555-7713")), ("212-555-0199", lambda t: permuted("phone", t))],
    "card": [("4111111111111111", card), ("4111-1111-1111-1111", card), ("3782 822463 10005", card)],
}


@pytest.mark.parametrize("kind", KINDS)
def test_pseudonyms(spark, docs, kind):
    texts = [f"Éa, {v}; (x) {v}." for v, _ in CASES[kind]]
    got = pseudonymize(docs(list(enumerate(texts))), KEY).orderBy("doc_id").collect()
    for (value, made), row in zip(CASES[kind], got, strict=True):
        assert row.text == f"Éa, {made(value)}; (x) {made(value)}."
        assert made(value) != value and row[f"n_{kind}"] == 2
        assert sum(row[f"n_{k}"] for k in KINDS) == 2


@pytest.mark.parametrize(
    "text",
    ["999.1.1.1", "2023-02-30", "000-12-3456", "4111111111111112", "version 1.2.3", "a@b", "12345", "1.2.3.4.5", "", " "],
)
def test_invalid_values_stay(spark, docs, text):
    row = one(spark, docs, text)
    assert row.text == text and sum(row[f"n_{k}"] for k in KINDS) == 0


def test_slash_dates_never_share(spark, docs):
    days = [date(1999, 1, 1) + timedelta(days=k) for k in range(3000)]
    values = [f"{d.month:02d}/{d.day:02d}/{d.year}" for d in days]
    values += [f"{d.day:02d}/{d.month:02d}/{d.year}" for d in days if d.day > 12]
    got = [r.text for r in pseudonymize(docs(list(enumerate(values))), KEY).orderBy("doc_id").collect()]
    assert len(set(got)) == len(values)
    assert [int(v[:2]) > 12 for v in values] == [int(g[:2]) > 12 for g in got]


@pytest.mark.parametrize("value", ["9999-12-31", "9998-01-05", "1799-12-31", "0301-01-01"])
def test_dates_at_the_ends(spark, docs, value):
    row = one(spark, docs, f"on {value}.")
    assert row.text == f"on {day(date.fromisoformat(value)).isoformat()}." and row.n_date == 1


def test_one_to_one(spark, docs):
    cards = []
    for k in range(0, 4000, 3):
        head = f"400000000{k:06d}"
        cards.append(head + next(c for c in "0123456789" if luhn(head + c)))
    days = [(date(1999, 1, 1) + timedelta(days=k)).isoformat() for k in range(1200)]
    for values in (cards, days, [f"10.0.{k // 256}.{k % 256}" for k in range(1500)], [f"219-09-{k:04d}" for k in range(1, 1500)]):
        got = [r.text for r in pseudonymize(docs(list(enumerate(values))), KEY).collect()]
        assert len(set(got)) == len(values)


def test_edges(spark, docs):
    rows = [(None, None), (None, "a@b.co"), (1, ""), (2, "a@b.co"), (2, "a@b.co"), (3, "x 10.2.3.4 " * 2000)]
    got = pseudonymize(docs(rows), KEY)
    new = permuted("email", "a") + "@b.co"
    want = [(None, None), (None, new), (1, ""), (2, new), (2, new), (3, f"x {ip('10.2.3.4')} " * 2000)]
    assert rows_of(got.select("doc_id", "text")) == sorted(want, key=repr)
    assert pseudonymize(docs([]), KEY).count() == 0


def test_key_matters(spark, docs):
    a, b = (pseudonymize(docs([(1, "10.2.3.44")]), k).first().text for k in ("one", "two"))
    assert a != b


def slash_or_other(text):
    """The date of a text in one of the formats and its parts' order, None if it is none."""
    parts = [int(p) for p in re.split(r"[-/.]", text)]
    if re.match(r"\d{4}", text):
        order = "ymd"
    elif text[2] == "/" and 1 <= parts[0] <= 12:
        order = "mdy"
    else:
        order = "dmy"
    at = dict(zip(order, parts, strict=True))
    try:
        return date(at["y"], at["m"], at["d"]), order
    except ValueError:
        return None


def replaced(text):
    """Text and kinds by plain Python, value by value."""
    kinds = []

    def made(match):
        m = match[0]
        digits = re.sub(r"\D", "", m)
        if "@" in m:
            kind, new = "email", permuted("email", m.split("@")[0]) + "@" + m.split("@")[1]
        elif re.fullmatch(r"\d+(\.\d+){3}", m):
            kind, new = "ip", ip(m) if all(int(o) < 256 for o in m.split(".")) else None
        elif re.fullmatch(r"\d{4}([-/])\d\d\1\d\d|\d\d[./]\d\d[./]\d{4}", m):
            kind, new = "date", None
            if (found := slash_or_other(m)) and len({c for c in m if not c.isdigit()}) == 1:
                out = day(found[0])
                new = re.search(r"\D", m)[0].join(
                    {"y": f"{out.year:04d}", "m": f"{out.month:02d}", "d": f"{out.day:02d}"}[c] for c in found[1]
                )
        elif re.fullmatch(r"\d{3}-\d\d-\d{4}", m):
            kind, new = "ssn", ssn(m) if re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", m) else None
        elif re.fullmatch(r"\d{13,19}|\d{4}([ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5}", m):
            kind, new = "card", card(m) if luhn(digits) else None
        else:
            head = re.match(r"[+]\d{1,3}[ .-]", m)
            n = head.end() if head else 0
            kind, new = "phone", m[:n] + permuted("phone", m[n:])
        if new is None:
            return m
        kinds.append(kind)
        return new

    return re.sub(PATTERN, made, text), kinds


def test_query(spark, sf_dir, monkeypatch):
    """Every row of the table: counts of each kind and the whole replaced text."""
    from perilgrid.llm.queries import QUERIES

    monkeypatch.setattr("tests.llm.test_pseudonyms.KEY", "pseudonym key")
    got = {r.doc_id: r for r in QUERIES["op7_pseudonyms"](spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        row = got.pop(r.doc_id)
        text, kinds = replaced(r.text)
        assert row.text == text
        assert {k: row[f"n_{k}"] for k in KINDS} == {k: kinds.count(k) for k in KINDS}
    assert not got
