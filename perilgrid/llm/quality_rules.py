"""Quality rules: how much of a text lies in repeated n-grams and repeated lines."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilgrid.llm.arrow import map_texts
from perilgrid.llm.shipping import ship_package

# Widely published limits: share of characters inside n-grams that occurred before (5 to 10 words),
# share of the characters that the most frequent short n-gram covers (2 to 4 words).
DUPLICATE_SHARE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
TOP_SHARE = {2: 0.20, 3: 0.18, 4: 0.16}
DUPLICATE_LINE_SHARE = 0.20
MIN_WORDS = 20
BASE_WINDOW = 8
BASE_REPEAT = 0.30

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_STEP = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, repeat_share double, top_share double, dup_line_share double, "
    "base_failed boolean, kept boolean"
)


def ngram_hashes(words: np.ndarray, longest: int):
    """Yield (n, rolling hash of every n-gram) for n = 1 .. longest, each from the one before."""
    rolled, power = words.copy(), np.uint64(1)
    for n in range(1, min(longest, len(words)) + 1):
        if n > 1:
            with np.errstate(over="ignore"):
                power = power * _STEP
                rolled = rolled[:-1] + words[n - 1 :] * power
        yield n, rolled


def repeated(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """True where a value occurs at least twice; the same without the first time."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    same = ranked[1:] == ranked[:-1]
    later = np.zeros(len(hashes), bool)
    later[order[1:][same]] = True
    mask = later.copy()
    mask[order[:-1][same]] = True
    return mask, later


def covered(starts: np.ndarray, n: int, n_words: int) -> np.ndarray:
    """Words inside any of the n-grams whose start is marked."""
    steps = np.zeros(n_words + 1, np.int32)
    steps[: len(starts)] += starts
    steps[n : n + len(starts)] -= starts
    return np.cumsum(steps[:-1]) > 0


def measure(text: str) -> dict:
    """All figures and the verdict of one text."""
    tokens = _WORD.findall(text)
    n_words = len(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, n_words)
    chars = int(lengths.sum())
    n_symbols = len(_SYMBOL.findall(text))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(t) for t in tokens), np.uint64, n_words)
    repeat_words, repeat_share, top_share, failed = 0, 0.0, 0.0, False
    for n, rolled in ngram_hashes(hashes, max(DUPLICATE_SHARE)):
        if n not in TOP_SHARE and n not in DUPLICATE_SHARE:
            continue
        again, later = repeated(rolled)
        if not again.any():
            break  # no longer n-gram can occur twice
        if n in TOP_SHARE:
            values, counts = np.unique(rolled[again], return_counts=True)
            mask = covered(rolled == values[counts.argmax()], n, n_words)
            share = int(lengths[mask].sum()) / chars
            top_share = max(top_share, share)
            failed |= share > TOP_SHARE[n]
        else:
            share = int(lengths[covered(later, n, n_words)].sum()) / chars
            repeat_share = max(repeat_share, share)
            failed |= share > DUPLICATE_SHARE[n]
            if n == BASE_WINDOW:
                repeat_words = int(covered(again, n, n_words).sum())
    dup_lines, dup_chars, line_chars, seen = 0, 0, 0, set()
    for line in text.split("\n"):
        if not _WORD.search(line):
            continue
        line_chars += len(line)
        if line in seen:
            dup_lines += 1
            dup_chars += len(line)
        else:
            seen.add(line)
    line_share = dup_chars / line_chars if line_chars else 0.0
    failed |= line_share > DUPLICATE_LINE_SHARE
    base_failed = n_words < MIN_WORDS or 100 * repeat_words > 100 * BASE_REPEAT * n_words
    return {
        "n_words": n_words,
        "word_chars": chars,
        "n_symbols": n_symbols,
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeat_words,
        "repeat_share": repeat_share,
        "top_share": top_share,
        "dup_line_share": line_share,
        "base_failed": bool(base_failed),
        "kept": not (base_failed or failed),
    }


def _rows(doc_id: list, text: list[str]) -> dict:
    found = [measure(t) for t in text]
    return {"doc_id": doc_id, **{k: [m[k] for m in found] for k in found[0]}}


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row of figures per row of ``docs`` (``doc_id``, ``text``; other columns are ignored).

    Words are runs of characters other than ASCII white space. Rolling hashes of 2 to 10 words
    mark n-grams that occur again in the same text; the shares are of the characters in words.
    ``kept`` is false below 20 words, if more than 30 % of the words lie in repeated 8-word
    windows, or if any published limit above is passed.

    A null text counts as empty and is not kept; a null or repeated doc_id is passed through, one
    row for each input row; an empty table gives no rows. Memory is in proportion to one text.
    """
    return map_texts(docs.select("doc_id", "text"), SCHEMA, _rows)


def filter_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns unchanged.

    The verdict is computed beside the row, so repeated ids are judged one by one.
    """
    ship_package(docs.sparkSession)

    @F.pandas_udf("boolean")
    def keeps(texts):
        return texts.map(lambda t: measure(t if t is not None else "")["kept"]).astype(bool)

    return docs.where(keeps(F.col("text")))
