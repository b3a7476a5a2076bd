"""Encoding texts with a public tokenizer, piece by piece."""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache

from tokenizers import Tokenizer, pre_tokenizers

# Pieces whose ids a worker remembers, and the longest one worth remembering; both bound memory.
CACHED_PIECES = 600_000
CACHED_LENGTH = 48

_SPACED = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")
# Letters whose pre-tokenizing, normal form and lower case are the same everywhere, then marks,
# which are a pre-token of their own after letters (apostrophes may be part of one).
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]{0,8})")


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Pieces(dict):
    """Ids of pieces, found on first use; ``prefix`` stands before every piece."""

    def __init__(self, tokenizer, prefix: str, lower: bool):
        super().__init__()
        self._tokenizer, self._prefix, self._lower = tokenizer, prefix, lower
        self._tokenize = tokenizer.model.tokenize
        table = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._bytewise = [table.pre_tokenize_str(chr(c))[0][0] for c in range(256)]
        self._head = prefix.translate(self._bytewise)
        self._marks: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return _pack(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        """One run of plain letters is one pre-token, so the model can be asked at once."""
        text = word.lower() if self._lower else word
        text = (self._prefix + text).translate(self._bytewise)
        return _pack([token.id for token in self._tokenize(text)])

    def __missing__(self, piece: str) -> bytes:
        if piece.isascii() and piece.isalpha():
            word = piece.lower() if self._lower else piece
            ids = _pack([token.id for token in self._tokenize(self._head + word)])
        elif plain := _PLAIN.fullmatch(piece):
            word, marks = plain.groups()
            if not marks:
                ids = self._word(piece)
            else:
                if marks not in self._marks:
                    self._marks[marks] = self._whole(marks)
                ids = self[word] + self._marks[marks]
        else:
            ids = self._whole(self._prefix + piece)
        if len(piece) <= CACHED_LENGTH:
            self[piece] = ids
        return ids


class PieceEncoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    A text is cut where the tokenizer cuts it whatever stands around, pieces are encoded by the
    ``tokenizers`` library, and the ids of short pieces are remembered:

    - byte-level pre-tokenizers: before a single space between two visible characters, and around
      a single line break between two (the pre-tokenizer's pattern starts anew there);
    - vocabularies that drop white space: at spaces and line breaks, as no normal form, pattern or
      added token reaches across them;
    - any other tokenizer gets whole texts.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._tokenizer = Tokenizer.from_file(path)
        self._mode = _mode(spec)
        if self._mode != "whole":
            words = self._mode == "words"
            self._heads = _Pieces(self._tokenizer, "", words)
            self._tails = _Pieces(self._tokenizer, " ", words)  # words after a space, without it

    def encode(self, text: str) -> bytes:
        if self._mode == "whole":
            return _pack(self._tokenizer.encode(text, add_special_tokens=False).ids)
        if len(self._heads) + len(self._tails) > CACHED_PIECES:
            self._heads.clear()
            self._tails.clear()
        if self._mode == "words":
            return b"".join(map(self._heads.__getitem__, text.replace("\n", " ").split(" ")))
        if any(pair in text for pair in ("  ", "\n\n", " \n", "\n ")):
            return self._encode_runs(text)
        heads, tails = self._heads.__getitem__, self._tails.__getitem__
        parts: list[bytes] = []
        for line in text.split("\n"):
            if not line or line[0].isspace() or line[-1].isspace():
                return self._encode_runs(text)
            words = iter(line.split(" "))
            parts.append(heads(next(words)))
            parts.extend(map(tails, words))
            parts.append(heads("\n"))
        return b"".join(parts[:-1])

    def _encode_runs(self, text: str) -> bytes:
        """The same for texts with runs of white space, cut at the safe places only."""
        pieces = _SPACED.split(text) if text else []
        return b"".join(
            [self._tails[p[1:]] if p[0] == " " and len(p) > 1 else self._heads[p] for p in pieces]
        )


def _mode(spec: dict) -> str:
    added = spec.get("added_tokens") or []
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"]) for t in added):
        return "whole"
    pre = spec.get("pre_tokenizer") or {}
    normal = spec.get("normalizer")
    if spec.get("post_processor") or spec.get("truncation") or spec.get("padding"):
        return "whole"
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not normal:
        return "spaced"
    steps = pre.get("pretokenizers", []) if pre.get("type") == "Sequence" else []
    kinds = [n.get("type") for n in (normal or {}).get("normalizers", [])]
    split = steps[0] if steps else {}
    drops = split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert")
    plain = not (set(kinds) - {"NFC", "Replace", "Lowercase"})
    no_space = r"[^\s\p{L}\p{N}]" in str(split.get("pattern", {}).get("Regex", ""))
    bytewise = len(steps) == 2 and steps[1].get("type") == "ByteLevel" and not steps[1].get("use_regex") and not steps[1].get("add_prefix_space")
    return "words" if drops and plain and no_space and bytewise else "whole"


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a tokenizer file."""
    return PieceEncoder(path)
