import random
import re
from datetime import datetime, timedelta

import pytest

import scdstar.functions.ordered as ordered
from scdstar.functions.ordered import previous_values, running_max_before

from conftest import rows


@pytest.fixture(scope="module")
def timeline(spark):
    """One entity owns most of the rows, and most of those share one time."""
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    data = []
    for i in range(600):
        entity = 0 if rng.random() < 0.7 else rng.randrange(1, 4)
        minute = 90 if rng.random() < 0.4 else rng.randrange(1200)
        data.append((entity, start + timedelta(minutes=minute), i * 7, rng.randrange(100),
                     None if rng.random() < 0.2 else rng.randrange(9)))
    return data, spark.createDataFrame(data, "e long, t timestamp_ntz, id long, v long, w long")


@pytest.fixture(autouse=True)
def small_ranges(monkeypatch):
    """Split rows of the same time into many ranges."""
    monkeypatch.setattr(ordered, "IDS_PER_RANGE", 100)


def brute(data, step):
    out, state = [], {}
    for e, t, i, v, w in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        value, state[e] = step(state.get(e), v, w)
        out.append((i, value))
    return sorted(out, key=repr)


def test_running_max_before(timeline):
    data, df = timeline
    got = running_max_before(df, "e", "t", "id", "v", "seen")
    assert got.columns == [*df.columns, "seen"]
    expected = brute(data, lambda s, v, w: (s, v if s is None else max(s, v)))
    assert rows(got, "id", "seen") == expected


def test_previous_values(timeline):
    data, df = timeline
    got = previous_values(df, "e", "t", "id", {"before": "w", "before_v": "v"})
    assert rows(got, "id", "before") == brute(data, lambda s, v, w: (s, w))
    assert rows(got, "id", "before_v") == brute(data, lambda s, v, w: (s, v))


def test_windows_over_rows_are_bounded(timeline):
    """Rows are windowed by entity, time and id range; only hours by entity alone."""
    _, df = timeline
    plan = running_max_before(df, "e", "t", "id", "v", "seen")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    windows = [re.findall(r"\[(?:e|t|_hour|_range)#[^]]*\]", line)[0]
               for line in text.splitlines() if "Window [" in line]
    keys = {re.sub(r"#\d+L?", "", w) for w in windows}
    assert keys == {"[e, _hour]", "[e, t, _range]", "[e]"}
