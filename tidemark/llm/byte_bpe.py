"""Byte-level BPE by a queue of merge ranks.

Tokens stand in linked lists, one per match of the split pattern; the lists of many matches lie in the same
arrays. Every rank has a bucket of positions. A hierarchy of bitmaps tells which buckets hold something: bit r of
the lowest level stands for bucket r, bit w of the next level for word w of the one below. Find-first-set down the
levels gives the smallest rank in constant time, and its whole bucket is merged at once: positions whose pair has
changed meanwhile are skipped, of overlapping ones the left one wins. Every merge shortens a list by one and adds
two entries at most, so a match of n bytes costs O(n) entries, however long it is.

Merging a bucket at once equals merging one position after the other as long as no merge makes a pair of smaller
rank than its own. Trained vocabularies hardly ever do; matches where it happens are done again one by one.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_of

_WORD_BITS = 6
#: Words are remembered up to this length; beyond this number a worker forgets those not in use.
_REMEMBERED_CHARS = 64
_REMEMBERED = 250_000
#: Texts of so many characters are merged together.
_PORTION = 3_000_000
#: Texts of so many lists of ids are put together at a time.
_LISTS = 256


class RankQueue:
    """Positions by rank; `pop` takes the whole bucket of the smallest rank."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.levels: list[list[int]] = []
        while not self.levels or len(self.levels[-1]) > 1:
            ranks = (ranks >> _WORD_BITS) + 1
            self.levels.append([0] * ranks)

    def push(self, rank: int, positions: list[int]) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.extend(positions)
            return
        self.buckets[rank] = positions
        index = rank
        for level in self.levels:
            word, bit = index >> _WORD_BITS, 1 << (index & 63)
            if level[word]:
                level[word] |= bit
                break
            level[word] = bit
            index = word

    def pop(self) -> tuple[int, list[int]] | None:
        if not self.levels[-1][0]:
            return None
        index = 0
        for level in reversed(self.levels):
            word = level[index]
            index = (index << _WORD_BITS) | ((word & -word).bit_length() - 1)
        rest = index
        for level in self.levels:
            word = rest >> _WORD_BITS
            level[word] &= ~(1 << (rest & 63))
            if level[word]:
                break
            rest = word
        return index, self.buckets.pop(index)


class BytePairs:
    """Encoder and decoder for a file of ranks (base64 of the token's bytes, its rank) and a split pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        in_order = [self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)]
        self.all_bytes = np.frombuffer(b"".join(in_order), dtype="uint8")
        self.token_bytes = np.cumsum([0, *map(len, in_order)])
        self.queue = RankQueue(max(self.ranks.values()) + 1)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype="int64")
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.array(sorted(pairs), dtype="int64")
        self.pair_keys = np.append(keys, np.int64((1 << 63) - 1))
        self.pair_ranks = np.append(np.array([pairs[k] for k in keys.tolist()], dtype="int64"), -1)
        # Ids of words; once there are too many, those that the texts at hand do not use are forgotten.
        self.known: dict[str, bytes] = {}

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens, -1 for pairs that do not merge."""
        keys = left << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def merge_one_by_one(self, match: bytes) -> list[int]:
        """Always the leftmost pair of smallest rank."""
        parts = [match[i : i + 1] for i in range(len(match))]
        while True:
            ranks = [self.ranks.get(a + b, 1 << 62) for a, b in zip(parts, parts[1:])]
            if not ranks or (smallest := min(ranks)) == 1 << 62:
                return [self.ranks[p] for p in parts]
            i = ranks.index(smallest)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def merge(self, matches: list[bytes]) -> tuple[bytes, np.ndarray]:
        """Little-endian 32-bit ids of all matches of the pattern (none is empty), and the number of each one's ids."""
        if not matches:
            return b"", np.empty(0, dtype="int64")
        lengths = np.array(list(map(len, matches)))
        ends = np.cumsum(lengths)
        starts = ends - lengths
        token = self.byte_ids[np.frombuffer(b"".join(matches), dtype="uint8")]
        n = len(token)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[starts] = -1
        rank_at = np.full(n, -1)
        inner = np.flatnonzero(after >= 0)
        rank_at[inner] = self._rank_of(token[inner], token[after[inner]])
        live = np.ones(n, dtype=bool)
        odd: set[int] = set()

        queue = self.queue
        filled = np.flatnonzero(rank_at >= 0)
        filled = filled[np.argsort(rank_at[filled], kind="stable")]
        ranks, first = np.unique(rank_at[filled], return_index=True)
        for rank, some in zip(ranks.tolist(), np.split(filled, first[1:])):
            queue.push(rank, some.tolist())
        while (smallest := queue.pop()) is not None:
            rank, positions = smallest
            left = np.sort(np.array(positions))
            if len(left) > 1:
                left = left[np.r_[True, left[1:] != left[:-1]]]
            left = left[rank_at[left] == rank]
            if not len(left):
                continue
            overlaps = np.r_[False, after[left[:-1]] == left[1:]]
            if overlaps.any():
                place = np.arange(len(left))
                run = np.maximum.accumulate(np.where(overlaps, 0, place))
                left = left[(place - run) % 2 == 0]
            gone = after[left]
            end = after[gone]
            token[left] = rank
            after[left] = end
            live[gone] = False
            rank_at[gone] = -1
            inside = end >= 0
            before[end[inside]] = left[inside]
            rank_at[left[~inside]] = -1
            back = before[left]
            again = np.concatenate([left[inside], back[back >= 0]])
            fresh = self._rank_of(token[again], token[after[again]])
            rank_at[again] = fresh
            order = np.argsort(fresh)
            order = order[np.searchsorted(fresh[order], 0) :]
            found, again = fresh[order], again[order]
            if not len(found):
                continue
            if found[0] < rank:
                odd.update(np.searchsorted(ends, again[found < rank], side="right").tolist())
            edges = [0, *(np.flatnonzero(found[1:] != found[:-1]) + 1).tolist(), len(found)]
            again = again.tolist()
            for a, b, r in zip(edges, edges[1:], found[edges[:-1]].tolist()):
                queue.push(r, again[a:b])
        ids = token[live].astype("<i4")
        counts = np.add.reduceat(live.astype("int64"), starts)
        if odd:
            each = np.split(ids, np.cumsum(counts)[:-1])
            for i in odd:
                each[i] = np.array(self.merge_one_by_one(matches[i]), dtype="<i4")
            ids, counts = np.concatenate(each), np.array(list(map(len, each)))
        return ids.tobytes(), counts

    def _ids_of_words(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of texts that the pattern may be applied to separately."""
        matches = [[m.encode() for m in self.pattern.findall(w)] for w in words]
        ids, counts = self.merge(list(chain.from_iterable(matches)))
        upto = np.concatenate([[0], np.cumsum(counts)])[np.cumsum([0, *map(len, matches)])] * 4
        edges = upto.tolist()
        return [ids[a:b] for a, b in zip(edges, edges[1:])]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts. No match of the pattern runs over the end of a word, so words can be remembered."""
        cut = [[t] if _UNSURE.search(t) else _WORDS.findall(t) for t in texts]
        here = set(chain.from_iterable(cut))
        if len(self.known) > _REMEMBERED:
            self.known = {w: self.known[w] for w in here & self.known.keys()}
        unknown = [w for w in here if w not in self.known]
        self.known.update(zip(unknown, self._ids_of_words(unknown)))
        ids_of = self.known.__getitem__
        ids = [np.frombuffer(b"".join(map(ids_of, words)), dtype="<i4") for words in cut]
        for word in unknown:
            if len(word) > _REMEMBERED_CHARS:
                del self.known[word]
        return ids

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of lists of ids that end at `ends`, one after the other, and where each list's bytes end."""
        lengths = self.token_bytes[ids + 1] - self.token_bytes[ids]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(upto[-1]) + np.repeat(self.token_bytes[ids] - upto[:-1], lengths)
        return self.all_bytes[at].tobytes(), upto[ends]


#: White space and the word behind it. Python's white space includes four control characters that the pattern's
#: does not; texts with one of them are matched as a whole.
_WORDS = re.compile(r"\s*\S+|\s+")
_UNSURE = re.compile("[\x1c-\x1f]")


def in_portions(texts: list[str], chars: int) -> Iterator[list[str]]:
    """Runs of texts of about so many characters, a single text at least."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > chars:
            yield texts[start:i]
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield texts[start:]


_LOADED: dict[tuple[str, str], BytePairs] = {}


def _loaded(path: str, pattern: str) -> BytePairs:
    """One encoder per worker and vocabulary."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = BytePairs(path, pattern)
    return _LOADED[path, pattern]


def _ids_array(pairs: BytePairs, texts: list[str]) -> pa.ListArray:
    found = pairs.encode(texts)
    offsets = np.cumsum([0, *map(len, found)]).astype("int32")
    flat = np.concatenate([np.empty(0, dtype="int32"), *found])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _bytes_array(pairs: BytePairs, lists: pa.ListArray) -> pa.Array:
    out = []
    for start in range(0, len(lists), _LISTS):
        some = lists.slice(start, _LISTS)
        ends = np.cumsum(some.value_lengths().to_numpy())
        joined, upto = pairs.decode(some.flatten().to_numpy(), ends)
        edges = [0, *upto.tolist()]
        out.extend(joined[a:b] for a, b in zip(edges, edges[1:]))
    return pa.array(out, type=pa.binary())


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All rows and columns of `docs` and the token ids (array of int) of the whole text, as column `ids`.

    Each match of `pattern` is merged separately by the ranks in the file at `path`, which every worker reads; there
    are no special tokens. A null or empty text has no ids. A column named like `ids` is replaced.
    """

    @F.arrow_udf("array<int>")
    def of(texts: pa.Array) -> pa.Array:
        pairs, out = _loaded(path, pattern), [pa.array([], type=pa.list_(pa.int32()))]
        out.extend(_ids_array(pairs, some) for some in in_portions(texts.to_pylist(), _PORTION))
        return pa.concat_arrays(out)

    return docs.withColumn(ids, of(text_of(text)))


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All rows and columns of `docs` and the bytes (binary) that the ids stand for; null ids have no bytes."""

    @F.arrow_udf("binary")
    def of(lists: pa.Array) -> pa.Array:
        return _bytes_array(_loaded(path, pattern), lists)

    return docs.withColumn(decoded, of(F.coalesce(F.col(ids), F.array().cast("array<int>"))))


def round_trip(
    docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """What `decode` makes of `encode`, in one visit of the worker: both columns, the bytes decoded from the ids."""

    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    def of(texts: pa.Array) -> pa.Array:
        pairs = _loaded(path, pattern)
        lists, parts = [pa.array([], type=pa.list_(pa.int32()))], [pa.array([], type=pa.binary())]
        for some in in_portions(texts.to_pylist(), _PORTION):
            lists.append(_ids_array(pairs, some))
            parts.append(_bytes_array(pairs, lists[-1]))
        return pa.StructArray.from_arrays([pa.concat_arrays(lists), pa.concat_arrays(parts)], names=["ids", "decoded"])

    both = docs.withColumn("_both", of(text_of(text)))
    return both.withColumns({ids: F.col("_both.ids"), decoded: F.col("_both.decoded")}).drop("_both")
