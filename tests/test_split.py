import datetime as dt
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidecast.operators.ranking import rank_in_time
from tidecast.operators.split import partition_counts, split_points, time_split, train_test
from tidecast.spec import PanelSpec

SCHEMA = "PARTITION_ID string, TS timestamp_ntz, FEATURE_1 double, TARGET double"
SPEC = PanelSpec()


def panel_rows(seed=7, copies=True):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 31)
    rows = []
    for grain, n in [("hot", 90), ("P0001", 1), ("P0002", 10), ("P12345", 33), (None, 5)]:
        for _ in range(n):
            ts = start + dt.timedelta(days=rng.randrange(120), hours=rng.randrange(3))
            rows.append((grain, None if rng.random() < 0.05 else ts, float(rng.randrange(4)), 1.0))
    if copies:
        rows += [("same", dt.datetime(2024, 3, 1), 2.0, 1.0)] * 25
    return rows


def brute_force(rows, pct):
    groups = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            groups[r[0]].append(r)
    train, test = Counter(), Counter()
    for part in groups.values():
        part.sort(key=lambda r: (r[1] is None, r[1] or dt.datetime.min, r[2:]))
        cut = math.floor(len(part) * (1.0 - pct))
        train.update(part[:cut])
        test.update(part[cut:])
    return train, test


@pytest.mark.parametrize("pct", [0.0, 0.1, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("max_task_rows", [1_000_000, 3])
def test_split_equals_brute_force(spark, pct, max_task_rows):
    rows = panel_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    labelled = time_split(df, SPEC, pct, max_task_rows)
    train, test = train_test(labelled)
    assert train.columns == df.columns
    want_train, want_test = brute_force(rows, pct)
    assert Counter(map(tuple, train.collect())) == want_train
    assert Counter(map(tuple, test.collect())) == want_test


@pytest.mark.parametrize("bucket", ["year", "month", "day", "hour", "minute"])
def test_bucket_unit_does_not_change_the_split(spark, bucket):
    rows = panel_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    spec = PanelSpec(bucket=bucket)
    train, _ = train_test(time_split(df, spec, 0.3))
    assert Counter(map(tuple, train.collect())) == brute_force(rows, 0.3)[0]


@pytest.mark.parametrize("max_task_rows", [1_000_000, 3])
def test_rank_covers_every_position_in_time_order(spark, max_task_rows):
    rows = panel_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    ranked = rank_in_time(df, SPEC, max_task_rows)
    assert ranked.columns == [*df.columns, "ROW_NUM"]
    got = defaultdict(list)
    for r in ranked.collect():
        got[r[0]].append(r)
    assert sum(map(len, got.values())) == sum(r[0] is not None for r in rows)
    for part in got.values():
        part.sort(key=lambda r: r.ROW_NUM)
        assert [r.ROW_NUM for r in part] == list(range(1, len(part) + 1))
        keys = [(r[1] is None, r[1] or dt.datetime.min, r[2]) for r in part]
        assert keys == sorted(keys)


def test_cutoff_uses_binary_double_arithmetic(spark):
    rows = [("g", dt.datetime(2024, 1, 1) + dt.timedelta(days=i), 0.0, 0.0) for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA)
    cut = {p: split_points(df, SPEC, p).table.first().TRAIN_CUTOFF for p in (0.1, 0.9)}
    assert cut == {0.1: 9, 0.9: 0}


def test_declared_key_gives_the_same_split_and_is_checked(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("g", base + dt.timedelta(days=i // 2), float(i % 2), 0.0) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    declared = PanelSpec(tiebreak=("FEATURE_1",), unique=True)
    train, _ = train_test(time_split(df, declared, 0.25))
    assert Counter(map(tuple, train.collect())) == brute_force(rows, 0.25)[0]
    wrong = PanelSpec(unique=True)
    with pytest.raises(ValueError, match="not unique"):
        time_split(df, wrong, 0.225).count()


def test_counts_join_split(spark):
    df = spark.createDataFrame(panel_rows(), SCHEMA)
    counts = {r[0]: r[1] for r in partition_counts(df, SPEC).collect()}
    assert counts["hot"] == 90 and counts[None] == 5
    labelled = time_split(df, SPEC, 0.1)
    named = df.filter(F.col("PARTITION_ID").isNotNull())
    both = labelled.drop("IS_TRAIN")
    assert both.exceptAll(named).isEmpty() and named.exceptAll(both).isEmpty()


@pytest.mark.parametrize("pct", [0.2, 0.5])
@pytest.mark.parametrize("max_task_rows", [1_000_000, 3])
def test_negative_zeros_survive(spark, pct, max_task_rows):
    day = dt.datetime(2024, 1, 1)
    rows = [("z", day, zero, 1.0) for zero in (0.0, -0.0, -0.0, 0.0, -0.0, 0.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for found in (rank_in_time(df, SPEC, max_task_rows), time_split(df, SPEC, pct, max_task_rows)):
        got = found.collect()
        assert Counter(math.copysign(1, r.FEATURE_1) for r in got) == {1.0: 3, -1.0: 3}
    assert sum(r.IS_TRAIN for r in got) == math.floor(6 * (1 - pct))
