"""PII: numbers, dates and addresses are permuted within their format by keyed Feistel rounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Formats, tried in this order at each place of the text (Java regular expressions).
FORMATS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9/-]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"
    r"|(?<![0-9+])\+[0-9]{8,15}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
}
KINDS = tuple(FORMATS)
PATTERN = "|".join(f"(?:{p})" for p in FORMATS.values())
ROUNDS = 8
CYCLE_STEPS = 64
DATE_STEPS = 256
# Days of a 400-year calendar cycle, 189 * 773; cycles are counted from this day.
_DAY_HIGH, _DAY_LOW, _DAY_ZERO = 189, 773, "DATE'1800-01-01'"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _digest(key: str, kind: str, *values: str) -> str:
    parts = ", ".join(f"CAST({v} AS STRING)" for v in values)
    return f"sha2(concat_ws('|', {_quoted(key)}, '{kind}', {parts}), 512)"


def _number(digest: str) -> str:
    return f"CAST(conv(substring({digest}, 1, 12), 16, 10) AS BIGINT)"


def _let(name: str, value: str, body: str) -> str:
    """Bind a value once inside a lambda."""
    return f"transform(array({value}), {name} -> {body})[0]"


def permuted_text(key: str, kind: str, text: str) -> str:
    """SQL: ``text`` permuted by Feistel rounds over its halves, each character within its class.

    Digits stay digits and letters letters of their case; other characters stay. Each round adds,
    character by character, a keyed digest of the other half, so the map is one-to-one for every
    pattern of classes. A digest serves 42 characters and then starts over.
    """
    shifted = """CASE WHEN c BETWEEN '0' AND '9' THEN char(48 + (ascii(c) - 48 + k) % 10)
        WHEN c BETWEEN 'a' AND 'z' THEN char(97 + (ascii(c) - 97 + k) % 26)
        WHEN c BETWEEN 'A' AND 'Z' THEN char(65 + (ascii(c) - 65 + k) % 26) ELSE c END"""

    def added(half: str, other: str) -> str:
        step = "CAST(conv(substring(g, 1 + 3 * ((j - 1) % 42), 3), 16, 10) AS INT)"
        char = _let("c", f"substring({half}, j, 1)", _let("k", step, shifted))
        chars = f"array_join(transform(sequence(1, length({half})), j -> {char}), '')"
        return f"CASE WHEN length({half}) = 0 THEN '' ELSE {_let('g', _digest(key, kind, 'i', other), chars)} END"

    rounds = f"""aggregate(sequence(1, {ROUNDS}),
        named_struct('a', substring(x, 1, length(x) div 2), 'b', substring(x, length(x) div 2 + 1)),
        (s, i) -> CASE WHEN i % 2 = 0 THEN named_struct('a', {added('s.a', 's.b')}, 'b', s.b)
                       ELSE named_struct('a', s.a, 'b', {added('s.b', 's.a')}) END,
        s -> concat(s.a, s.b))"""
    return _let("x", text, rounds)


def _card_ok(digits: str) -> str:
    """SQL: the check digit of a string of digits is right."""
    return f"luhn_check({digits})"


def _refilled(shape: str, digits: str) -> str:
    """SQL: ``shape`` with its digits replaced by those of ``digits``, in order."""
    return f"""aggregate(sequence(1, length({shape})), named_struct('out', '', 'at', 1), (s, i) ->
        CASE WHEN substring({shape}, i, 1) BETWEEN '0' AND '9'
             THEN named_struct('out', concat(s.out, substring({digits}, s.at, 1)), 'at', s.at + 1)
             ELSE named_struct('out', concat(s.out, substring({shape}, i, 1)), 'at', s.at) END, s -> s.out)"""


def _card(key: str, m: str) -> str:
    """The first digit stays, the others but the last are permuted, the check digit follows."""
    inner = permuted_text(key, "card", "substring(d, 2, length(d) - 2)")
    body = _let("p", f"concat(substring(d, 1, 1), {inner})", "concat(p, filter(sequence(0, 9), q -> luhn_check(concat(p, q)))[0])")
    return _let("d", f"regexp_replace({m}, '[^0-9]', '')", _let("n", body, _refilled(m, "n")))


def _ssn_ok(text: str) -> str:
    return f"{text} RLIKE '^(?!000|666|9)[0-9]{{3}}-(?!00)[0-9]{{2}}-(?!0000)[0-9]{{4}}$'"


def _ssn(key: str, m: str) -> str:
    """Permuted again until the number is valid, which keeps the map one-to-one."""
    again = permuted_text(key, "ssn", "v")
    return f"""aggregate(sequence(1, {CYCLE_STEPS}), {permuted_text(key, 'ssn', m)},
        (v, t) -> CASE WHEN {_ssn_ok('v')} THEN v ELSE {again} END)"""


def _phone(key: str, m: str) -> str:
    """Country code and shape stay, the other digits are permuted."""
    code = f"regexp_extract({m}, '^([+][0-9]{{1,3}}[ .-])', 1)"
    return _let("h", code, f"concat(h, {_let('r', f'substring({m}, length(h) + 1)', permuted_text(key, 'phone', 'r'))})")


def _email(key: str, m: str) -> str:
    """The local part is permuted, the domain stays."""
    return f"concat({permuted_text(key, 'email', f'substring_index({m}, chr(64), 1)')}, chr(64), substring_index({m}, chr(64), -1))"


def _ip_ok(m: str) -> str:
    return f"forall(split({m}, '[.]'), o -> CAST(o AS INT) <= 255)"


def _ip(key: str, m: str) -> str:
    """The address is a number of two 16-bit halves."""
    f = f"{_number(_digest(key, 'ip', 'i', 's.b'))} % 65536"
    start = "named_struct('a', CAST(o[0] AS BIGINT) * 256 + CAST(o[1] AS BIGINT), 'b', CAST(o[2] AS BIGINT) * 256 + CAST(o[3] AS BIGINT))"
    mixed = f"aggregate(sequence(1, {ROUNDS}), {start}, (s, i) -> named_struct('a', s.b, 'b', s.a ^ ({f})))"
    out = "concat_ws('.', n.a div 256, n.a % 256, n.b div 256, n.b % 256)"
    return _let("o", f"split({m}, '[.]')", _let("n", mixed, out))


_DATE_SHAPES = (
    # a date as MM/dd/yyyy where that is one, else as dd/MM/yyyy
    ("^[0-9]{4}-", "yyyy-MM-dd"),
    ("^[0-9]{4}/", "yyyy/MM/dd"),
    ("^[0-9]{2}[.]", "dd.MM.yyyy"),
    ("^(0[1-9]|1[0-2])/", "MM/dd/yyyy"),
    ("^[0-9]{2}/", "dd/MM/yyyy"),
)


def _parsed(m: str) -> str:
    cases = " ".join(f"WHEN {m} RLIKE '{shape}' THEN try_to_timestamp({m}, '{form}')" for shape, form in _DATE_SHAPES)
    return f"CAST(CASE {cases} END AS DATE)"


def _date(key: str, m: str) -> str:
    """The day is permuted within its 400-year cycle, written in the same format.

    Permuted again until the year has four digits and the day of the month is above 12 just where
    the input's is. So a slash date keeps its reading, and no two dates of one format meet.
    """
    cycle = _DAY_HIGH * _DAY_LOW

    def mixed(v: str) -> str:
        return f"""aggregate(sequence(1, {ROUNDS}),
            named_struct('a', pmod({v}, {cycle}L) div {_DAY_LOW}L, 'b', pmod({v}, {cycle}L) % {_DAY_LOW}L),
            (s, i) -> CASE WHEN i % 2 = 0
                THEN named_struct('a', (s.a + {_number(_digest(key, 'date', 'i', 's.b'))}) % {_DAY_HIGH}L, 'b', s.b)
                ELSE named_struct('a', s.a, 'b', (s.b + {_number(_digest(key, 'date', 'i', 's.a'))}) % {_DAY_LOW}L) END,
            s -> {v} - pmod({v}, {cycle}L) + s.a * {_DAY_LOW}L + s.b)"""

    def at(v: str) -> str:
        return f"date_add({_DAY_ZERO}, CAST({v} AS INT))"

    fits = f"year({at('v')}) BETWEEN 1 AND 9999 AND (day({at('v')}) > 12) = (day(t) > 12)"
    day = f"CAST(datediff(day, {_DAY_ZERO}, t) AS BIGINT)"
    walked = f"""aggregate(sequence(1, {DATE_STEPS}), {mixed('y')},
        (v, j) -> CASE WHEN {fits} THEN v ELSE {mixed('v')} END, v -> {at('v')})"""
    cases = " ".join(f"WHEN {m} RLIKE '{shape}' THEN date_format(w, '{form}')" for shape, form in _DATE_SHAPES)
    written = _let("w", walked, f"CASE {cases} END")
    return _let("t", _parsed(m), _let("y", day, written))


def _kind(m: str) -> str:
    """SQL: the validated kind of a match, null if it is none."""
    tests = {
        "email": f"contains({m}, '@')",
        "ip": f"{m} RLIKE {_quoted('^[0-9]+(?:[.][0-9]+){3}$')}",
        "date": f"{m} RLIKE {_quoted('^(?:[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})$')}",
        "ssn": f"{m} RLIKE {_quoted('^[0-9]{3}-[0-9]{2}-[0-9]{4}$')}",
        "card": f"{m} RLIKE {_quoted('^(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$')}",
    }
    valid = {
        "email": "true",
        "ip": _ip_ok(m),
        "date": f"{_parsed(m)} IS NOT NULL",
        "ssn": _ssn_ok(m),
        "card": _card_ok(f"regexp_replace({m}, '[^0-9]', '')"),
    }
    cases = " ".join(f"WHEN {tests[k]} THEN CASE WHEN {valid[k]} THEN '{k}' END" for k in tests)
    return f"CASE {cases} ELSE 'phone' END"


def pseudonym(key: str, kind: str, m: str) -> str:
    """SQL: the pseudonym of match ``m`` of kind ``kind``; unknown kinds stay as they are."""
    made = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}
    cases = " ".join(f"WHEN '{k}' THEN {made[k](key, m)}" for k in KINDS)
    return f"CASE {kind} {cases} ELSE {m} END"


def replace_pii(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and a column ``_kinds`` of the kinds found, in order."""
    pattern = _quoted(PATTERN)
    # every format has a digit or an at sign: most texts need no more than this test
    matches = f"CASE WHEN text RLIKE '[0-9@]' THEN regexp_extract_all(text, {pattern}, 0) ELSE array() END"
    rows = docs.select("*", F.expr(f"inline(array(named_struct('_m', {matches})))"))
    kinds = f"transform(_m, m -> {_kind('m')})"
    rows = rows.select("*", F.expr(f"inline(array(named_struct('_kinds', {kinds})))"))
    made = f"zip_with(_m, _kinds, (m, kind) -> {pseudonym(key, 'kind', 'm')})"
    new = f"""CASE WHEN exists(_kinds, kind -> kind IS NOT NULL)
        THEN array_join(flatten(zip_with(split(text, {pattern}, -1), {made}, (gap, p) -> array(gap, coalesce(p, '')))), '')
        ELSE text END"""
    rows = rows.select("*", F.expr(f"inline(array(named_struct('_new', {new})))"))
    kept: list[Column] = [F.col("_new").alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return rows.select(*kept, "_kinds")


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, n_<kind> for each kind, text) of every row, its PII replaced by pseudonyms.

    Kinds: e-mail addresses, IPv4 addresses, calendar dates, social security numbers, telephone
    numbers and payment cards. Numbers and dates are validated (octets, calendar, number ranges,
    check digit) and stay valid; what is not valid stays as it is. The pseudonym depends on ``key``
    and the value alone, so equal values stay linked across documents; different values of one
    format never share one. A date in two formats keeps one pseudonym.

    Null texts stay null; repeated rows and null doc_ids keep their rows; an empty table gives no
    rows; other columns are ignored. DataFrame functions only, one pass without a shuffle.
    """
    rows = replace_pii(docs.select("doc_id", "text"), key)
    counts = [F.expr(f"CAST(size(filter(_kinds, k -> k = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, "text")
