import random
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing, queries, sharding

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_slots(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return slots


def test_shards_are_even(spark, documents):
    rows = sharding.shard(documents, carry=["doc_id", "text"]).collect()
    assert len(rows) == documents.count()
    check_slots(rows)
    held = defaultdict(int)
    for r in rows:
        assert r.size == len((r.text or "").encode()) + 16
        held[r.shard] += r.size
    mean, largest = sum(held.values()) / 40, max(r.size for r in rows)
    assert set(held) == set(range(40))
    assert max(abs(x - mean) for x in held.values()) <= largest + 0.01 * mean


def test_equal_texts_are_neighbours_and_a_hot_group_is_cut(spark):
    rows = [(i, "the same text") for i in range(2000)] + [(5000 + i, f"text {i}" * 3) for i in range(2000)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sharding.shard(table, shards=10).collect()
    check_slots(found)
    held = defaultdict(int)
    same = set()
    for r in found:
        held[r.shard] += r.size
        if r.text == "the same text":
            same.add(r.shard)
    assert max(held.values()) - min(held.values()) <= 0.02 * sum(held.values()) / 10 + 60
    assert sorted(same) == list(range(min(same), max(same) + 1))


def test_odd_rows_in_shards(odd, nothing):
    found = sharding.shard(odd)
    assert sorted(found.columns) == sorted({*odd.columns, "size", "shard", "slot"})
    rows = found.collect()
    assert len(rows) == odd.count()
    check_slots(rows)
    assert sharding.shard(nothing).count() == 0


@pytest.mark.parametrize("tokens", [0, 1, 7, 313, 1337, 2047, 2048, 2049, 99_999])
def test_cuts_fill_their_bins(tokens):
    lengths = packing.cut(tokens)
    assert sum(lengths) == tokens
    assert all(2048 % length <= packing.SLACK for length in lengths)


def ids_of(texts):
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_words_equal_whole_texts():
    rng = random.Random(8)
    signs = list("aAbZ  \n\t\x1c\x1f\x85\xa0　éÉİſÅ̊'sS12.!,漢字") + ["'ll", " the", "J̌", "́", "<|endoftext|>", "ΑΣ"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    check_ids(texts)


def check_ids(texts):
    found = list(map(packing.WordIds(PATH).ids, texts))
    want = [b"".join(i.to_bytes(4, "little") for i in ids) for ids in ids_of(texts)]
    assert found == want


def test_every_latin_character_between_others():
    some = ["a", "1", ",", "É", " "]
    texts = [a + chr(c) + b for c in range(0x300) for a in some for b in some]
    check_ids(texts + [chr(c) * 2 for c in range(0x300)])


def test_literals_of_special_tokens_are_those_tokens():
    literals = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext", "|>", " ", "a", "É漢", "'s", "\x1d"]
    rng = random.Random(9)
    texts = ["".join(rng.choice(literals) for _ in range(rng.randint(0, 8))) for _ in range(2000)]
    assert ids_of(["a <|endoftext|> b"])[0][1] == 49407
    check_ids(texts)


def check_packed(rows, texts):
    """Every id in one piece, pieces gapless in their sequences, little padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for id, ids in zip(texts, ids_of([t or "" for t in texts.values()])):
        at, ids = 0, [*ids, 1]
        for r in sorted(by_doc[id], key=lambda r: r.start):
            part = ids[r.start : r.start + r.length]
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            at += r.length
        assert at == len(ids)
    total = 0
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        total += at
    return 1 - total / (2048 * len(by_sequence))


def test_packing_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert check_packed(queries.op5_packing(spark, sf_dir).collect(), texts) < 0.02


def test_many_workers(spark, monkeypatch):
    monkeypatch.setattr(packing, "_WORKER_PIECES", 40)
    monkeypatch.setattr(packing, "_MERGED_WORKERS", 3)
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert check_packed(queries.op5_packing(spark, sf_dir).collect(), texts) < 0.05


def test_odd_rows_are_packed(odd, nothing):
    packed = packing.pack_documents(odd, PATH).cache()
    assert packed.agg(F.sum("length")).first()[0] == sum(len(x) + 1 for x in ids_of([r.text or "" for r in odd.collect()]))
    filled = packing.sequences(packed).collect()
    assert all(len(r.ids) == 4 * 2048 and 0 < r.n_tokens <= 2048 for r in filled)
    assert sum(r.n_tokens for r in filled) == packed.agg(F.sum("length")).first()[0]
    assert packing.pack_documents(nothing, PATH).count() == 0
