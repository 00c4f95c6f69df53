"""Packing token sequences by reciprocal-capacity classes (harmonic packing).

A piece of length c belongs to the class k = capacity // c, and a bin of class k takes exactly k pieces. Documents
are cut so that k pieces fill a bin up to `slack` tokens: from the front, always the longest piece for which
capacity mod c is within the slack. Bins need no search: workers number the pieces of each class on their own and
every k in a row are a bin. What is left (fewer than k pieces of a class in each worker) is handed to ever fewer
workers. The last remains, fewer than k pieces of each class in the whole corpus, go into mixed bins; their
number depends on the capacity alone.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import in_portions
from tidemark.llm.common import pieces as smaller
from tidemark.llm.common import stored, text_of

CAPACITY = 2048
SLACK = 8
END_OF_DOCUMENT = 1
_WORKER_PIECES = 200_000
_MERGED_WORKERS = 64
_REMEMBERED = 200_000
_LONG_WORD = 64
_PORTION = 2_000_000


@lru_cache
def good_lengths(capacity: int, slack: int) -> list[int]:
    return [c for c in range(1, capacity + 1) if capacity % c <= slack]


@lru_cache(maxsize=1 << 14)
def _cut_rest(rest: int, capacity: int, slack: int) -> tuple[int, ...]:
    good, out = good_lengths(capacity, slack), []
    while rest:
        out.append(good[bisect_right(good, rest) - 1])
        rest -= out[-1]
    return tuple(out)


def cut(tokens: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    return [capacity] * (tokens // capacity) + list(_cut_rest(tokens % capacity, capacity, slack))


# The tokenizer lower-cases, drops white space and never joins what white space, digits or kinds of characters
# part, so the ids of words may be remembered. Latin text (no combining marks, so nothing to compose) is cut into the
# tokenizer's own words; in other text only white space parts. Letters, digits and white space up to U+02AF
# as they are after lower-casing, which leads out of that range for two letters.
_LETTERS = "a-zªµºß-öø-ʯⱥⱦ"
_DIGITS = "0-9²³¹¼-¾"
_WHITE = " \t\n\r\f\v\x85\xa0"
_NOT_LATIN = re.compile("[^\x00-ʯ]")
_LATIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_WHITE}{_LETTERS}{_DIGITS}]+")
_UNSURE = re.compile("[\x1c-\x1f]")


class _Remembered(dict):
    """Ids of words, made when a word is first asked for; long words are not kept."""

    def __init__(self, ids_of: Callable[[str], bytes]):
        self.ids_of, self.before = ids_of, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.ids_of(word)
        if len(word) <= _LONG_WORD:
            self[word] = ids
        return ids

    def forget(self) -> None:
        """Of too many words those stay that have been asked for since the last time."""
        if len(self) > _REMEMBERED:
            self.before = self.copy()
            self.clear()


def _byte_letters() -> str:
    """The character that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(others)) for b in range(256))


class WordIds:
    """Ids of whole texts as little-endian unsigned 32-bit numbers, equal to those of the tokenizer's plain call.

    Literals of added tokens, such as <|endoftext|>, are cut out first and become that one token, as in that call.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        added = {token.content: i for i, token in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = {literal: i.to_bytes(4, "little") for literal, i in added.items()}
        self.literals = re.compile(f"({'|'.join(map(re.escape, added))})") if added else None
        self.latin, self.other = _Remembered(self._ids_of_latin), _Remembered(self._ids_of_other)

    def _ids_of_latin(self, word: str) -> bytes:
        """One of the tokenizer's own words, lower-cased: only its bytes are left to be merged."""
        if not (word.isascii() and word.isprintable()):
            word = word.encode().decode("latin-1").translate(self.letters)
        return b"".join([token.id.to_bytes(4, "little") for token in self.merge(word)])

    def _ids_of_other(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        if text.isascii() or not _NOT_LATIN.search(text):
            return b"".join(map(self.latin.__getitem__, _LATIN_WORDS.findall(text.lower())))
        words = [text] if _UNSURE.search(text) else text.split()
        return b"".join(map(self.other.__getitem__, words))

    def ids(self, text: str) -> bytes:
        self.latin.forget()
        self.other.forget()
        if self.literals and self.literals.search(text):
            return b"".join(self.added.get(part) or self._plain(part) for part in self.literals.split(text))
        return self._plain(text)


_LOADED: dict[str, WordIds] = {}


def _loaded(path: str) -> WordIds:
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def token_pieces(
    docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, slack: int = SLACK
) -> DataFrame:
    """One row per piece: id, _row (tells documents apart), start, length, doc_tokens, ids (binary), k.

    The ids of a document are those of the tokenizer at `path` over its whole text (null counts as empty), then the
    id 1; a document without text is that id alone. `ids` holds unsigned 32-bit little-endian numbers.
    """
    end = END_OF_DOCUMENT.to_bytes(4, "little")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _loaded(path)
        for batch in smaller(batches, 2000):
            names, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts, at = batch.column(2).to_pylist(), 0
            for some in in_portions(texts, _PORTION):
                out: list[list] = [[], [], [], [], [], [], []]
                for i, text in enumerate(some, at):
                    ids = words.ids(text) + end
                    tokens, start = len(ids) // 4, 0
                    for length in cut(tokens, capacity, slack):
                        piece = ids[4 * start : 4 * (start + length)]
                        for column, value in zip(out, (names[i], rows[i], start, length, tokens, piece, capacity // length)):
                            column.append(value)
                        start += length
                at += len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(out, (batch.schema.types[0], *[pa.int64()] * 4, pa.binary(), pa.int32()))],
                    names=["id", "row", "start", "length", "doc_tokens", "ids", "k"],
                )

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.monotonically_increasing_id().alias("row"), text_of(text).alias("text"))
    schema = f"id {kind}, row long, start long, length long, doc_tokens long, ids binary, k int"
    found = rows.mapInArrow(of, schema)
    return found.select(F.col("id").alias(id), F.col("row").alias("_row"), "start", "length", "doc_tokens", "ids", "k")


def _mixed_bins(capacity: int):
    """First fit by falling length: the few pieces that fill no bin of their class."""

    def fill(rest: pd.DataFrame) -> pd.DataFrame:
        rest = rest.sort_values(["length", "_row", "start"], ascending=[False, True, True], kind="stable")
        room: list[int] = []
        place, offset, first = [], [], 0
        for length in rest["length"].tolist():
            while first < len(room) and room[first] == 0:
                first += 1
            b = next((b for b in range(first, len(room)) if room[b] >= length), len(room))
            if b == len(room):
                room.append(capacity)
            place.append(b)
            offset.append(capacity - room[b])
            room[b] -= length
        return rest.assign(_bin=place, offset=offset).astype({"_bin": "int64", "offset": "int64"})

    return fill


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset; `pieces` is stored and has _row, start, length and k.

    A sequence id holds, from high to low bits: round (4), class (12), worker (23) and bin (24).
    """
    columns = [c for c in pieces.columns if c != "k"]
    workers = max(1, -(-pieces.count() // _WORKER_PIECES))
    rest, done, turn = pieces, [], 0
    while True:
        dealt = rest.withColumn("_worker", F.pmod(F.xxhash64("_row"), F.lit(workers)))
        whole = Window.partitionBy("k", "_worker")
        dealt = dealt.withColumn("_at", F.row_number().over(whole.orderBy("_row", "start")) - 1)
        dealt = dealt.withColumn("_n", F.count(F.lit(1)).over(whole)).withColumn("_bin", F.floor(F.col("_at") / F.col("k")))
        within = Window.partitionBy("k", "_worker", "_bin").orderBy("_at")
        dealt = dealt.withColumn("offset", F.sum("length").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length"))
        full = (F.col("_bin") + 1) * F.col("k") <= F.col("_n")
        dealt = stored(dealt.withColumn("_full", full), "packed")
        number = (F.lit(turn).cast("long") * (1 << 59)) + F.col("k").cast("long") * (1 << 47)
        number = number + F.col("_worker") * (1 << 24) + F.col("_bin")
        done.append(dealt.where("_full").select(*columns, number.alias("sequence_id"), "offset"))
        rest = dealt.where(~F.col("_full")).select(*pieces.columns)
        turn += 1
        if workers == 1:
            break
        workers = -(-workers // _MERGED_WORKERS)
    # Fewer than k pieces of each class are left in all, so one task suffices at any size of the corpus.
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name != "k")
    last = rest.drop("k").groupBy().applyInPandas(_mixed_bins(capacity), f"{kinds}, _bin long, offset long")
    number = F.lit(15).cast("long") * (1 << 59) + F.col("_bin")
    done.append(last.select(*columns, number.alias("sequence_id"), "offset"))
    return reduce(DataFrame.unionByName, done)


def pack_documents(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Every id of every document in exactly one piece: id, start, length, doc_tokens, ids, sequence_id, offset.

    Rows with equal or null ids are documents of their own; a null or empty text is the closing id alone; other
    columns play no part, whatever their names. An empty table gives an empty result.
    """
    return pack(stored(token_pieces(docs, path, id, text, capacity), "pieces"), capacity).drop("_row")


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids): the pieces of each sequence one after the other, padded with the id `pad`."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda all, part: F.concat(all, part["ids"]))
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
    padding = F.repeat(F.lit(pad.to_bytes(4, "little")), (F.lit(capacity) - F.col("n_tokens")).cast("int"))
    return rows.withColumn("ids", F.concat("ids", padding.cast("binary")))
