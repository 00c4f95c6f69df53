import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import byte_bpe, queries

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def pairs():
    return byte_bpe.BytePairs(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def published(pairs):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pairs.ranks, special_tokens={})


def strange_texts():
    rng = random.Random(3)
    signs = list("aab  \n\t\x1c\x1f\x85\xa0　é'sS1２.!,漢字\U0001f600") + ["'ll", " the", "\r\n", "ing"]
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]


def test_ids_equal_the_published_encoder(pairs, published):
    texts = strange_texts()
    assert [x.tolist() for x in pairs.encode(texts)] == [published.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("text", ["a" * 50_000, "ab" * 30_000, " " * 40_000, "!?" * 10_000, "é" * 9_999])
def test_very_long_matches(pairs, published, text):
    assert pairs.encode([text])[0].tolist() == published.encode_ordinary(text)


def test_one_by_one_is_the_same(pairs):
    words = [w.encode() for w in ["reading", "aaaaaaa", "Überraschung", "xyzzy", "tokenization"]]
    ids, counts = pairs.merge(words)
    assert ids == b"".join(i.to_bytes(4, "little") for w in words for i in pairs.merge_one_by_one(w))
    assert counts.tolist() == [len(pairs.merge_one_by_one(w)) for w in words]


def test_queue_gives_ranks_in_order():
    queue, rng = byte_bpe.RankQueue(100_000), random.Random(1)
    ranks = [rng.randrange(100_000) for _ in range(2000)]
    for at, rank in enumerate(ranks):
        queue.push(rank, [at])
    out = []
    while (found := queue.pop()) is not None:
        out.append(found[0])
        assert sorted(found[1]) == [i for i, r in enumerate(ranks) if r == found[0]]
    assert out == sorted(set(ranks))


def test_odd_rows_and_round_trip(odd, published):
    encoded = byte_bpe.encode(odd, PATH, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, PATH, public_tokenizers.PATTERN)
    assert decoded.columns == [*odd.columns, "ids", "decoded"]
    for r in decoded.collect():
        assert r.ids == published.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_empty_table(nothing):
    assert byte_bpe.encode(nothing, PATH, public_tokenizers.PATTERN).count() == 0


def test_query(spark, published):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op2_byte_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = published.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
