"""Burrows-Wheeler transforms of string collections, and merging them by interleave refinement."""

from __future__ import annotations

import numpy as np

END = 0  # symbol that ends every string; bytes are shifted up by one
_BITS, _PACKED = 9, 4  # symbols in one key


class Transforms:
    """Burrows-Wheeler transforms of the strings of each shard, laid end to end.

    ``shard_of`` gives the shard of each string. For the p-th suffix (shards in turn, each in its
    own order) ``bwt[p]`` is the symbol before it (END where its string begins), ``key[p]`` its
    first symbols, and ``shard[p]``, ``string[p]``, ``offset[p]`` say which suffix it is.
    """

    def __init__(self, strings: list[bytes], shard_of: np.ndarray, depth: int):
        lengths = np.array([len(s) for s in strings], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        text = np.zeros(int(starts[-1]), np.int64)
        if strings:
            text[:] = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
            text += 1
        ends = starts[1:] - 1
        text[ends] = END
        owner = np.repeat(np.arange(len(strings)), lengths + 1)
        shard = np.asarray(shard_of, np.int64)[owner] if strings else owner
        key = _first_symbols(text, ends[owner])
        order = _sorted_suffixes(key, shard, ends[owner], depth)
        self.key, self.shard, self.string = key[order], shard[order], owner[order]
        self.offset = order - starts[self.string]
        self.bwt = np.where(self.offset > 0, text[order - 1] if len(text) else text, END).astype(np.int16)

    def __len__(self) -> int:
        return len(self.bwt)

    def longer(self) -> np.ndarray:
        """Place of the suffix one symbol longer than each one, by counting in its shard; -1 if none."""
        before = np.empty(len(self), np.int64)
        before[_by_shard(self.bwt, self.shard)] = np.arange(len(self))
        before[self.bwt == END] = -1
        return before


def _order(key: np.ndarray) -> np.ndarray:
    """Stable order of non-negative numbers; those short enough are sorted with their place below."""
    bits = len(key).bit_length()
    if not len(key) or int(key.max()) >> (63 - bits):
        return np.argsort(key, kind="stable")
    return np.sort((key << bits) | np.arange(len(key))) & ((1 << bits) - 1)


def _by_shard(values: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Stable order by shard, then value."""
    order = _order(values.astype(np.int64))
    narrow = shard.astype(np.uint16) if not len(shard) or shard.max() < 1 << 16 else shard
    return order[np.argsort(narrow[order], kind="stable")]


def _first_symbols(text: np.ndarray, end_of: np.ndarray) -> np.ndarray:
    """The first symbols of every suffix as one number."""
    at = np.arange(len(text))
    key = np.zeros(len(text), np.int64)
    for k in range(_PACKED):
        key = (key << _BITS) | text[np.minimum(at + k, end_of)]
    return key


def _sorted_suffixes(key: np.ndarray, shard: np.ndarray, end_of: np.ndarray, depth: int) -> np.ndarray:
    """Positions by shard and the suffixes' first ``depth`` symbols (at least).

    Prefix doubling; a suffix that differs from all others of its shard is not looked at again.
    """
    n = len(key)
    order = _by_shard(key, shard)
    if not n:
        return order
    rank_of = np.empty(n, np.int64)
    opens = _group_starts(key[order]) | _group_starts(shard[order])
    rank_of[order] = np.nonzero(opens)[0][np.cumsum(opens) - 1]
    slots = _shared(opens, np.arange(n))
    reach = _PACKED
    while reach < depth and len(slots):
        open_ = order[slots]
        key = rank_of[open_] * (n + 1) + rank_of[np.minimum(open_ + reach, end_of[open_])]
        sorted_ = _order(key)
        order[slots] = open_[sorted_]
        opens = _group_starts(key[sorted_])
        rank_of[order[slots]] = slots[np.nonzero(opens)[0][np.cumsum(opens) - 1]]
        slots = _shared(opens, slots)
        reach *= 2
    return order


def _group_starts(ranked: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, bool)


def _shared(opens: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Slots of groups of two and more."""
    closes = np.append(opens[1:], True)
    return slots[~(opens & closes)]


class Merged:
    """Transforms merged into one order, known to ``depth`` symbols.

    The interleave of the shards is refined symbol by symbol: after round h, ``block[p]`` is the
    place in the merged order where the suffixes begin that share their first h symbols with the
    p-th one (shards laid end to end, each in its own order). A block splits in round h + 1 only
    where the suffixes one symbol shorter were split in round h, so each round visits the
    predecessors (found by counting in the transforms) of the suffixes that moved in the last one,
    and ends early when nothing moves. No suffix is compared with another one.

    The rounds that the packed first symbols settle are taken at once. ``lcp`` holds the common
    prefix of the suffixes on both sides of each split, by its place.
    """

    def __init__(self, transforms: Transforms, depth: int):
        n = len(transforms)
        before = transforms.longer()
        # the first rounds at once: the shards carry the first symbols of their suffixes
        key = transforms.key.copy()
        known = min(_PACKED, depth)
        key >>= _BITS * (_PACKED - known)
        order = _order(key)
        ranked = key[order]
        opens = _group_starts(ranked)
        heads = np.nonzero(opens)[0]
        self.block = np.empty(n, np.int64)
        self.block[order] = heads[np.cumsum(opens) - 1] if n else heads
        size = np.zeros(n + 1, np.int64)
        size[heads] = np.diff(np.append(heads, n))
        self.lcp = np.full(n + 1, -1, np.int32)
        self.lcp[heads] = _common_symbols(ranked, heads, known)
        elder = _group_starts(ranked >> _BITS)
        parent = np.empty(n, np.int64)
        parent[order] = np.nonzero(elder)[0][np.cumsum(elder) - 1] if n else heads
        moved = np.nonzero(self.block != parent)[0]
        self.rounds = known
        while self.rounds < depth and len(moved):
            seen = moved[before[moved] >= 0]
            longer = before[seen]
            key = self.block[longer] * (n + 1) + self.block[seen]
            order = _order(key)
            longer, key = longer[order], key[order]
            if not len(key):
                break
            opens = np.concatenate([[True], key[1:] != key[:-1]])
            group = np.cumsum(opens) - 1
            head = np.nonzero(opens)[0]
            sizes = np.diff(np.append(head, len(key)))
            parent = self.block[longer[head]]
            new_parent = np.concatenate([[True], parent[1:] != parent[:-1]])
            family = np.cumsum(new_parent) - 1
            eldest = np.nonzero(new_parent)[0]
            leaving = np.add.reduceat(sizes, eldest)
            stay = size[parent[eldest]] - leaving
            inside = np.cumsum(sizes) - sizes
            start = parent + stay[family] + inside - inside[eldest][family]
            fresh = start != parent
            size[parent[eldest]] = np.where(stay > 0, stay, size[parent[eldest]])
            size[start] = sizes
            self.lcp[start[fresh]] = self.rounds
            self.block[longer] = start[group]
            moved = longer[fresh[group]]
            self.rounds += 1

    def interleave(self) -> np.ndarray:
        """The merged order: places of ``block`` sorted by it, shards in turn where it is equal."""
        return np.argsort(self.block, kind="stable")


def _common_symbols(ranked: np.ndarray, heads: np.ndarray, known: int) -> np.ndarray:
    """Symbols that the key at each place of ``heads`` shares with the one before."""
    common = np.zeros(len(heads), np.int32)
    later = heads[1:]
    for k in range(1, known):
        drop = _BITS * (known - k)
        common[1:] += (ranked[later] >> drop) == (ranked[later - 1] >> drop)
    return common


def repeated_starts(
    strings: list[bytes], weights: np.ndarray, length: int, shard_of: np.ndarray | None = None
) -> list[np.ndarray]:
    """For each string, at which offsets ``length`` bytes start that occur again.

    ``weights`` counts the copies of each string. The strings are transformed by shards (by default
    each is one), and merged; blocks of the merged order at depth ``length`` are the repeated
    intervals.
    """
    found = Transforms(strings, np.arange(len(strings)) if shard_of is None else shard_of, length)
    merged = Merged(found, length)
    sizes = np.array([len(s) for s in strings], np.int64)
    whole = found.offset + length <= sizes[found.string] if len(found) else np.zeros(0, bool)
    name, offset, block = found.string[whole], found.offset[whole], merged.block[whole]
    copies = np.bincount(block, weights=weights[name]) if len(block) else np.zeros(1)
    again = copies[block] >= 2 if len(block) else np.zeros(0, bool)
    name, offset = name[again], offset[again]
    order = np.lexsort((offset, name))
    name, offset = name[order], offset[order]
    cuts = np.searchsorted(name, np.arange(len(strings) + 1))
    return [offset[cuts[i] : cuts[i + 1]] for i in range(len(strings))]
