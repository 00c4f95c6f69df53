import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup
from tidemark.llm.common import cell_filter, in_filter


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute(rows):
    groups = defaultdict(list)
    for id, text in rows:
        groups[normal(text)].append((-len(text or ""), id is None, id if id is not None else 0, id))
    return {key: (len(g), min(g)[3]) for key, g in groups.items()}


@pytest.mark.parametrize("max_bits", [28, 20])
def test_against_brute_force(odd, max_bits):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = sorted(
        (str(id), str(best), n, hashlib.sha256(normal(t).encode()).hexdigest())
        for id, t in rows
        for n, best in [brute(rows)[normal(t)]]
    )
    got = exact_dedup.exact_duplicates(odd, max_bits=max_bits).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len(brute(rows))


def test_documents_that_stay(odd):
    kept = exact_dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    found = brute([(r.doc_id, r.text) for r in odd.collect()])
    assert len(rows) == len(found)
    assert all(found[normal(r.text)][1] == r.doc_id for r in rows)


def test_empty_table(nothing):
    assert exact_dedup.exact_duplicates(nothing).count() == 0
    assert exact_dedup.drop_exact_duplicates(nothing).count() == 0


def test_filter_has_every_repeated_hash(spark):
    rows = spark.range(3000).select(F.xxhash64("id").alias("h"))
    rows = rows.unionByName(rows.limit(200)).repartition(5)
    chunks = cell_filter(rows, "h", 20, least=2)
    once = rows.groupBy("h").count()
    hashes = once.toPandas()
    found = in_filter(chunks, 20, hashes["h"].to_numpy())
    assert found[hashes["count"] > 1].all()
    assert found[hashes["count"] == 1].mean() < 0.01
