import re

import pytest

from tidemark.llm import line_dedup


def key_of(line):
    line = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
    return re.sub("[A-Z]", lambda m: m[0].lower(), line)


def brute(rows):
    first = {}
    order = lambda id: (id is None, id or 0)
    for id, text in rows:
        for line in (text or "").split("\n"):
            k = key_of(line)
            if len(k) >= 10:
                first[k] = min(first.get(k, id), id, key=order)
    out = []
    for id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if first.get(key_of(x), id) == id]
        out.append((id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches", [1, 4])
def test_against_brute_force(odd, batches):
    found = line_dedup.drop_repeated_lines(odd, batches=batches)
    assert found.columns == [*odd.columns, "n_lines", "n_dropped"]
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in odd.collect()])


def test_runs_are_merged_by_level(spark):
    runs = line_dedup.LineRuns(spark)
    for b in range(5):
        rows = spark.range(b * 10, b * 10 + 15).selectExpr(f"{b} as doc", "id as h", "id as h2")
        lost = {r.h for r in runs.add_batch(rows).collect()}
        assert lost == (set(range(b * 10, b * 10 + 5)) if b else set())
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = [r for level in runs.levels for name in level for r in spark.table(name).collect()]
    assert sorted(r.h for r in held) == list(range(55))
    plan = spark.table(runs.levels[2][0]).join(spark.table(runs.levels[0][0]).hint("merge"), ["h", "h2"], "left")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    runs.close()


def test_empty_table(nothing):
    assert line_dedup.drop_repeated_lines(nothing).count() == 0
