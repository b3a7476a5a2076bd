"""Secret scan: known forms, and strings that pass a battery of randomness tests."""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilgrid.llm.arrow import map_texts
from perilgrid.session import new_dir

_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the whole runs of 24 and more
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
KINDS = ("assign", "access", "hex", "random")

# Encodings from the smallest alphabet to the largest, each with the probability that two symbols
# drawn from ordinary text of that alphabet are equal (digits of numbers, letters of words).
_UPPER, _LOWER, _DIGITS = string.ascii_uppercase, string.ascii_lowercase, string.digits
ENCODINGS = (
    ("decimal", _DIGITS, 0.12),
    ("hex", _DIGITS + "abcdef", 0.20),
    ("HEX", _DIGITS + "ABCDEF", 0.20),
    ("base32", _UPPER + "234567", 0.065),
    ("letters", _LOWER, 0.065),
    ("base36", _DIGITS + _LOWER, 0.060),
    ("base62", _DIGITS + _UPPER + _LOWER, 0.055),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/", 0.050),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_", 0.050),
    ("mixed", _UPPER + _LOWER + _DIGITS + "+/-_", 0.050),
)
FALSE_DISCOVERIES = 0.01
ORDER_LEVEL = 0.001
STEPS = 16  # levels for each halving of a p-value
LAST_LEVEL = STEPS * 1100  # beyond the smallest positive double


def _normal_below(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _codes(token: str) -> tuple[np.ndarray, int, float]:
    """Symbol numbers, alphabet size and text coincidence of the smallest fitting encoding."""
    symbols = set(token)
    for _, alphabet, coincidence in ENCODINGS:
        if symbols.issubset(alphabet):
            break
    table = np.zeros(128, np.int64)
    table[np.frombuffer(alphabet.encode(), np.uint8)] = np.arange(len(alphabet))
    return table[np.frombuffer(token.encode(), np.uint8)], len(alphabet), coincidence


def uniformity(codes: np.ndarray, size: int, coincidence: float) -> float:
    """How likely ordinary text spreads over the alphabet as evenly as this.

    Pearson's statistic against the uniform alphabet; under text it is non-central, its
    non-centrality grows with the length, so short strings can hardly be discovered.
    """
    n = len(codes)
    counts = np.bincount(codes, minlength=size)
    statistic = float((counts.astype(float) ** 2).sum()) * size / n - n
    shift = n * (size * coincidence - 1)
    freedom = size - 1
    return _normal_below((statistic - freedom - shift) / math.sqrt(2 * (freedom + 2 * shift)))


def runs(codes: np.ndarray, size: int) -> float:
    """Two-sided p-value of the number of runs above and below the middle of the alphabet."""
    high = codes >= size / 2
    n1, n = int(high.sum()), len(codes)
    n2 = n - n1
    if not n1 or not n2:
        return 0.0
    expected = 1 + 2 * n1 * n2 / n
    variance = (expected - 1) * (expected - 2) / (n - 1)
    count = 1 + int((high[1:] != high[:-1]).sum())
    return math.erfc(abs(count - expected) / math.sqrt(2 * variance)) if variance > 0 else 0.0


def serial_correlation(codes: np.ndarray) -> float:
    """Two-sided p-value of the correlation of neighbours."""
    x = codes - codes.mean()
    power = float((x * x).sum())
    if not power:
        return 0.0
    r = float((x[1:] * x[:-1]).sum()) / power
    n = len(codes)
    return math.erfc(abs(r + 1 / n) * math.sqrt(n / 2))


def level(token: str) -> int:
    """Evidence against ordinary text, the p-value by length as steps of a logarithmic scale.

    The p-value is that of the uniformity test, and one where the order is not random by runs or
    serial correlation. Division by the length weights it: long strings get more of the error budget.
    """
    codes, size, coincidence = _codes(token.rstrip("="))
    p = uniformity(codes, size, coincidence)
    if 2 * min(runs(codes, size), serial_correlation(codes)) < ORDER_LEVEL:
        p = 1.0
    return math.floor(-STEPS * math.log2(p / len(codes))) if p > 0 else LAST_LEVEL


def lowest_level(counts: dict[int, int], mean_length: float) -> int:
    """The level from which strings are secrets at a bounded share of false ones.

    Weighted Benjamini-Hochberg over the counts of all strings by level.
    """
    total, above, lowest = sum(counts.values()), 0, LAST_LEVEL + 1
    for k in sorted(counts, reverse=True):
        above += counts[k]
        if mean_length * 2 ** (-k / STEPS) <= FALSE_DISCOVERIES * above / total:
            lowest = k
    return lowest


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the known forms, sorted."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, level, length) of the strings outside the base spans that are tested."""
    found = []
    for match in _CANDIDATE.finditer(text):
        if not any(start <= match.start() and match.end() <= end for start, _, end in base):
            token = match.group()
            found.append((match.start(), match.end(), level(token), len(token.rstrip("="))))
    return found


def find_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and the random strings outside them, of a text that is the whole corpus."""
    base = base_spans(text)
    tested = candidates(text, base)
    if not tested:
        return base, []
    lowest = lowest_level(Counter(k for _, _, k, _ in tested), sum(n for *_, n in tested) / len(tested))
    return base, [(start, 3, end) for start, end, k, _ in tested if k >= lowest]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _rows(doc_id: list, text: list[str]) -> dict:
    bases = [base_spans(t) for t in text]
    tested = [candidates(t, base) for t, base in zip(text, bases, strict=True)]
    # all spans in order; those of known forms have no level
    spans = [
        sorted([(*s, -1, 0) for s in base] + [(start, 3, end, k, n) for start, end, k, n in more])
        for base, more in zip(bases, tested, strict=True)
    ]
    kinds = [[sum(k == kind for _, k, _ in base) for base in bases] for kind in range(3)]
    return {
        "doc_id": doc_id,
        "n_assign": kinds[0],
        "n_access": kinds[1],
        "n_hex": kinds[2],
        "base_sha256": [hashlib.sha256(_joined(base).encode()).hexdigest() for base in bases],
        **{name: [[s[i] for s in row] for row in spans] for i, name in enumerate(("begin", "kind", "end", "level", "length"))},
    }


def secret_scan(docs: DataFrame) -> DataFrame:
    """One row (doc_id, counts by kind, base_sha256, spans) per row of ``docs``.

    Base spans are assignments to a password-like name, access keys and long lower-case hex runs.
    Other strings of 20 and more symbols are tested: the encoding is inferred from the symbols,
    and those spread too evenly for ordinary text, in random order, are added as ``random``. The
    limit is set once over all strings of the table, from their counts by level, so that equal
    strings get equal verdicts in whatever text they stand.
    Positions are code points, ends exclusive; spans are joined as kind:start:end by start.

    Null and empty texts have no spans (''); repeated rows and null doc_ids keep their rows; an
    empty table gives no rows; other columns are ignored. Memory is in proportion to one text.
    """
    path = new_dir(docs.sparkSession, "tested-strings")
    map_texts(
        docs.select("doc_id", "text"),
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
        "begin array<long>, kind array<long>, end array<long>, level array<long>, length array<long>",
        _rows,
    ).write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    tested = rows.select(F.explode(F.arrays_zip("level", "length")).alias("s")).where("s.level >= 0")
    counts = tested.groupBy("s.level").agg(F.count("*").alias("n"), F.sum("s.length").alias("symbols")).collect()
    total = sum(r.n for r in counts)
    lowest = lowest_level({r.level: r.n for r in counts}, sum(r.symbols for r in counts) / total) if total else 0
    found = rows.withColumn("s", F.expr(f"filter(arrays_zip(begin, kind, end, level), s -> s.kind < 3 OR s.level >= {lowest})"))
    names = ", ".join(f"'{k}'" for k in KINDS)
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.expr("CAST(size(filter(s, x -> x.kind = 3)) AS BIGINT)").alias("n_random"),
        "base_sha256",
        F.expr(f"array_join(transform(s, x -> concat_ws(':', get(array({names}), CAST(x.kind AS INT)), x.begin, x.end)), ',')").alias("spans"),
    )
