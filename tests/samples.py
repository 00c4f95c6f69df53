"""Small inputs with known answers, and features computed the slow, obvious way."""

from datetime import datetime, timedelta

import numpy as np

START = datetime(2024, 3, 1)
SCHEMA = "trans_num string, cc_num string, trans_date_trans_time timestamp_ntz, amt double"


def txns(spark, rows):
    """rows of (id, card, minutes after START, amount)"""
    data = [(i, c, START + timedelta(minutes=m), float(a)) for i, c, m, a in rows]
    return spark.createDataFrame(data, SCHEMA)


def random_rows(n, seed, days=3, cards=("A", "B", "C"), hot=0.0):
    """Whole minutes, so ties and exact window borders occur; `hot` is the extra share of the first card."""
    rng = np.random.default_rng(seed)
    minutes = np.sort(rng.integers(0, days * 24 * 60, n))
    amounts = np.round(rng.gamma(2, 40, n), 2) + 1
    names = [cards[0] if rng.random() < hot else cards[rng.integers(0, len(cards))] for _ in range(n)]
    return [(f"t{i:05d}", names[i], int(minutes[i]), float(amounts[i])) for i in range(n)]


def slow_history(rows, windows=(("1h", 60), ("24h", 1440)), cap=604800):
    out = {}
    for id_, card, minute, amount in rows:
        mine = [r for r in rows if r[1] == card]
        before = [r for r in mine if (r[2], r[0]) < (minute, id_)]
        features = []
        for _, length in windows:
            seen = [r[3] for r in mine if minute - length <= r[2] < minute]
            features += [float(len(seen)), float(sum(seen))]
        gap = min((minute - max(r[2] for r in before)) * 60.0, cap) if before else float(cap)
        ratio = amount / (sum(r[3] for r in before) / len(before)) if before else 1.0
        out[id_] = [*features, gap, ratio]
    return out
