import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests import folds
from tvtrail.operators import hotkeys, orders, paths
from tvtrail.schemas import BOOT_PAGE

SCHEMA = "user_id string, state string, ts bigint, rid bigint, pagename string, status string"


def random_events(seed, hot_rows=300):
    rng = random.Random(seed)
    rows = []
    for u in range(25):
        for _ in range(hot_rows if u == 0 else rng.randrange(1, 9)):
            state = rng.choice(["0x07", "0x07", "0x07", "0x01", "0x09"])
            name = rng.choice(["", "a", "b", "c", "d"]) if state == "0x07" else ""
            status = rng.choice(["0", "1"]) if state == "0x09" else ""
            rows.append((f"u{u}", state, rng.randrange(500), len(rows), name, status))
    return rows


def hot_of(df):
    hot = hotkeys.find_hot_keys(df, "user_id", "ts", slice_rows=40)
    assert hot
    return hot


def test_hand_cases(spark):
    rows = [("abc", "0x07", 1, 1, "a", ""), ("abc", "0x07", 2, 2, "b", ""), ("abc", "0x07", 3, 3, "c", ""),
            ("one", "0x07", 1, 4, "a", ""), ("on", "0x01", 1, 5, "", ""), ("on", "0x07", 2, 6, "a", ""),
            ("same", "0x01", 2, 7, "", ""), ("same", "0x07", 2, 8, "a", ""), ("only", "0x01", 2, 9, "", "")]
    got = paths.path_trigrams(spark.createDataFrame(rows, SCHEMA), hotkeys.NO_HOT_KEYS)
    by_user = defaultdict(set)
    for r in got.collect():
        by_user[r.user_id].add(tuple(r)[1:])
    assert by_user["abc"] == {("", "", "a"), ("", "a", "b"), ("a", "b", "c"), ("b", "c", ""), ("c", "", "")}
    assert by_user["one"] == by_user["same"] == {("", "", "a"), ("a", "", "")}
    assert by_user["on"] == {("", BOOT_PAGE, "a"), (BOOT_PAGE, "a", ""), ("a", "", "")}
    assert "only" not in by_user


@pytest.mark.parametrize("seed", [1, 2])
def test_trigrams_match_the_fold(spark, seed):
    rows = random_events(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    kinds = {"0x07": "page", "0x01": "on"}
    want = folds.trigrams(
        [(u, kinds[s], t, i, n) for u, s, t, i, n, _ in rows if s in kinds], BOOT_PAGE)
    for hot in (hotkeys.NO_HOT_KEYS, hot_of(df)):
        got = paths.path_trigrams(df, hot).select("user_id", *paths.NAMES)
        assert sorted(tuple(r) for r in got.collect()) == want


def test_in_out_paths(spark):
    rows = random_events(3)
    df = spark.createDataFrame(rows, SCHEMA)
    want = Counter()
    for user in {r[0] for r in rows}:
        names = [n for _, _, n in sorted((t, i, n) for u, s, t, i, n, _ in rows if u == user and s == "0x07" and n)]
        padded = ["", "", *names, "", ""]
        for i in range(2, len(names) + 2):
            want[(padded[i], padded[i + 1], padded[i + 2], 0)] += 1
            want[(padded[i], padded[i - 1], padded[i - 2], 1)] += 1
    for hot in (hotkeys.NO_HOT_KEYS, hot_of(df)):
        got = {tuple(r)[:4]: r.ct for r in paths.in_out_counts(df, hot).collect()}
        assert got == dict(want)


def test_orders_match_the_fold(spark):
    rows = random_events(4)
    df = spark.createDataFrame(rows, SCHEMA)
    want = folds.last_pages([r for r in rows if r[1] in ("0x07", "0x09")])
    for hot in (hotkeys.NO_HOT_KEYS, hot_of(df)):
        got = orders.order_last_page(df, hot).select("user_id", "rid", "pagename")
        assert sorted(tuple(r) for r in got.collect()) == want


def by_rank(rows, near, middle, far, keep):
    """Two rankings over rows of (names dict, ct)."""
    groups = defaultdict(list)
    for names, ct in rows:
        groups[(names[near], names[middle])].append((-ct, names[far]))
    second = Counter()
    for pair, members in groups.items():
        for place, (ct, name) in enumerate(sorted(members)):
            second[(*pair, name if place < keep else "other")] += -ct
    sums = defaultdict(Counter)
    for (a, b, _), ct in second.items():
        sums[a][b] += ct
    out = Counter()
    for (a, b, c), ct in second.items():
        top = sorted(sums[a], key=lambda m: (-sums[a][m], m))[:keep]
        out[(a, b, c) if b in top else (a, "other", "other")] += ct
    return dict(out)


@pytest.mark.parametrize("end", [False, True])
def test_top_paths(spark, end):
    rng = random.Random(9)
    triples = {(rng.choice("xy"), f"m{rng.randrange(9)}", f"f{rng.randrange(30)}") for _ in range(400)}
    rows = [(*t, rng.randrange(1, 6), f"v{rng.randrange(3)}", "20240102", "HNYD") for t in sorted(triples)]
    rows = [(c, b, a, *rest) for a, b, c, *rest in rows] if end else rows
    df = spark.createDataFrame(rows, "page_name string, page_name2 string, page_name3 string, ct long, "
                                     "apk_version string, dt string, platform string")
    near, middle, far = ("page_name3", "page_name2", "page_name") if end else paths.NAMES
    want = by_rank([(dict(zip(paths.NAMES, r)), r[3]) for r in rows], near, middle, far, 4)
    got = {(r[near], r[middle], r[far]): r.ct for r in paths.top_paths(df, end, keep=4).collect()}
    assert got == want
    assert sum(got.values()) == sum(r[3] for r in rows)
    assert df.where(F.col("ct") > 0).count() > len(got)
