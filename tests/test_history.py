import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from samples import random_rows, slow_history, txns
from tidemark.operators.history import WINDOWS, _slice_width, history_features
from tidemark.operators.parity import parity_report
from tidemark.operators.state import read_state, snapshot, write_state
from tidemark.schemas import HISTORY_FEATURES

FOUR = [("a", "X", 0, 10), ("b", "X", 30, 20), ("c", "X", 120, 30), ("d", "X", 3000, 100)]
ROUTES = [None, 0, 2]


def features(df, **options):
    rows = history_features(df, **options).collect()
    return {r["trans_num"]: [r[f] for f in HISTORY_FEATURES] for r in rows}


@pytest.mark.parametrize("hot_rows", ROUTES)
def test_four_rows_by_hand(spark, hot_rows):
    got = features(txns(spark, FOUR), hot_rows=hot_rows)
    assert got == {
        "a": [0, 0, 0, 0, 604800, 1],
        "b": [1, 10, 1, 10, 1800, 2],
        "c": [0, 0, 2, 30, 5400, 2],
        "d": [0, 0, 0, 0, 172800, 5],
    }


@pytest.mark.parametrize("hot_rows", ROUTES)
def test_a_later_row_changes_nothing_before_it(spark, hot_rows):
    before = features(txns(spark, FOUR), hot_rows=hot_rows)
    after = features(txns(spark, [*FOUR, ("e", "X", 3001, 9999)]), hot_rows=hot_rows)
    assert {k: after[k] for k in before} == before


def test_cards_do_not_share_history(spark):
    got = features(txns(spark, [("a", "X", 0, 10), ("b", "Y", 30, 20), ("c", "X", 40, 30)]))
    assert got["b"] == [0, 0, 0, 0, 604800, 1]
    assert got["c"] == [1, 10, 1, 10, 2400, 3]


@pytest.mark.parametrize("hot_rows", ROUTES)
def test_border_is_inside_and_ties_are_not(spark, hot_rows):
    rows = [("a", "X", 0, 1), ("b", "X", 60, 2), ("c", "X", 60, 4), ("d", "X", 1440, 8), ("e", "X", 1441, 16)]
    got = features(txns(spark, rows), hot_rows=hot_rows)
    assert got["b"][:2] == [1, 1] and got["c"][:2] == [1, 1]
    assert got["d"][2:4] == [3, 7] and got["e"][2:4] == [3, 14]
    assert got["c"][4] == 0 and got["c"][5] == pytest.approx(4 / 1.5)


@pytest.mark.parametrize("hot_rows", ROUTES)
@pytest.mark.parametrize("seed", [0, 3])
def test_random_rows_against_the_slow_way(spark, seed, hot_rows):
    rows = random_rows(400, seed, hot=0.4)
    got, want = features(txns(spark, rows), hot_rows=hot_rows), slow_history(rows)
    assert set(got) == set(want)
    for id_ in want:
        assert got[id_] == pytest.approx(want[id_], rel=1e-9, abs=1e-9)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("XY"), st.integers(0, 3000), st.integers(1, 500)), min_size=1, max_size=40))
def test_routes_agree(spark, drawn):
    rows = [(f"{i:03d}", c, m, a) for i, (c, m, a) in enumerate(drawn)]
    plain = features(txns(spark, rows), hot_rows=None)
    sliced = features(txns(spark, rows), hot_rows=0, slice_seconds=700)
    for id_ in plain:
        assert sliced[id_] == pytest.approx(plain[id_], rel=1e-9)


def test_slices_divide_every_window():
    spans = {name: s * 1_000_000 for name, s in WINDOWS.items()}
    assert _slice_width(spans, 900_000_000) == 900_000_000
    assert all(us % _slice_width(spans, 700_000_000) == 0 for us in spans.values())


@pytest.mark.parametrize("hot_rows", ROUTES)
def test_continuing_from_a_stored_state(spark, tmp_path, hot_rows):
    rows = random_rows(300, 7)
    cut = rows[200][2]
    past, live = [r for r in rows if r[2] < cut], [r for r in rows if r[2] >= cut]
    write_state(snapshot(txns(spark, past)), str(tmp_path / "state"))
    state = read_state(spark, str(tmp_path / "state"))
    online = history_features(txns(spark, live), before=state, hot_rows=hot_rows)
    offline = history_features(txns(spark, rows)).where(f"trans_num >= '{live[0][0]}'")
    report = parity_report(online, offline, "trans_num", HISTORY_FEATURES).collect()
    assert len(report) == 6 and all(r["equal"] and r["compared"] == len(live) for r in report)


def test_parity_report_sees_differences_and_missing_rows(spark):
    left = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "id string, f double")
    right = spark.createDataFrame([("a", 1.5), ("c", 2.0)], "id string, f double")
    row = parity_report(left, right, "id", ["f"]).first()
    assert (row["compared"], row["missing_offline"], row["missing_online"]) == (1, 1, 1)
    assert row["max_abs_diff"] == 0.5 and not row["equal"]


def test_state_keeps_the_border_row(spark):
    state = snapshot(txns(spark, [("a", "X", 0, 1), ("b", "X", 1, 2), ("c", "X", 1441, 4)]))
    assert sorted(r["id"] for r in state.recent.collect()) == ["b", "c"]
    total = state.totals.first()
    assert (total["total_count"], total["total_amount"]) == (3, 7.0)


def test_plan_has_no_window_over_a_whole_hot_key(spark):
    plan = history_features(txns(spark, FOUR), hot_rows=0)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "_here_" in line]
    assert windows and all("_slice" in line for line in windows)
