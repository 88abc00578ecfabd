"""Late rows, replays and interrupted swaps leave the history of the whole feed in order."""
import random
from datetime import timedelta

import pytest

from snapline.operators import merge
from snapline.operators.merge import compact_dates, finish_swaps, partition_dirs, read_history
from snapline.streaming.repair import load_with_repair
from snapline.streaming.silver import stored_schema
from tests.test_loads import SCHEMA, SPEC, START, feed, fold, stored


def rows_of(spark, path):
    return sorted((r["k"], r["t"], r["v"]) for r in stored(spark, path, feed(spark, [])).collect() if r["t"] is not None and r["k"] is not None)


def load(spark, rows, root, i):
    return load_with_repair(feed(spark, rows), f"{root}/h", f"{root}/landed", f"b{i}", SPEC, typed=True)


def test_a_late_row_brings_back_what_it_separates(spark, tmp_path):
    h = lambda n: START + timedelta(hours=n)
    assert load(spark, [("a", h(1), 5), ("a", h(3), 5), ("b", h(1), 1)], tmp_path, 0) == (2, 0)
    assert load(spark, [("a", h(2), 7)], tmp_path, 1) == (2, 0)
    assert rows_of(spark, f"{tmp_path}/h") == [("a", h(1), 5), ("a", h(2), 7), ("a", h(3), 5), ("b", h(1), 1)]
    # A row that makes a stored one a repetition takes it back; a replay changes nothing.
    assert load(spark, [("b", h(4), 2)], tmp_path, 2) == (1, 0)
    assert load(spark, [("b", h(2), 2), (None, h(2), 9), ("b", None, 9)], tmp_path, 3) == (3, 1)
    want = [("b", h(1), 1), ("b", h(2), 2)]
    assert [r for r in rows_of(spark, f"{tmp_path}/h") if r[0] == "b"] == want
    assert load(spark, [("a", h(2), 7)], tmp_path, 1) == (0, 0)


@pytest.mark.parametrize("seed", [5, 6])
def test_any_arrival_order(spark, tmp_path, seed):
    r = random.Random(seed)
    rows = sorted({(r.choice(["hot", "hot", "a", "b"]), START + timedelta(hours=r.randint(0, 24 * 40))) for _ in range(150)})
    rows = [(k, t, int(r.random() < 0.3)) for k, t in rows]
    dealt = rows[:]
    r.shuffle(dealt)
    for i in range(3):
        load(spark, dealt[i::3], tmp_path, i)
        so_far = [x for j in range(i + 1) for x in dealt[j::3]]
        assert {(k, t) for k, t, _ in rows_of(spark, f"{tmp_path}/h")} == fold(so_far)


def test_an_interrupted_swap_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "h")
    rows = [("a", START, 1), ("b", START, 1), ("a", START + timedelta(days=1), 2)]
    merge.write_history(feed(spark, rows), path, SPEC, "b0", stamp_col=None)
    monkeypatch.setattr(merge, "finish_swaps", lambda *a: None)
    schema = merge.history_schema(feed(spark, []).schema, SPEC)
    day = [START.date()]
    only = read_history(spark, path, schema, SPEC).filter("k = 'a'").filter(f"day = DATE '{START.date()}'").drop("batch_id")
    merge.replace_dates(only, path, SPEC, day, "r1")
    monkeypatch.undo()
    count = lambda: read_history(spark, path, schema, SPEC).count()
    assert count() == 3                                     # ready, not swapped: the old content stands
    finish_swaps(spark, path, SPEC)
    assert count() == 2
    finish_swaps(spark, path, SPEC)
    assert count() == 2 and compact_dates(spark, path, schema, SPEC, day) == 1
    assert [v for v, _ in partition_dirs(spark, f"{path}/day={START.date()}", "batch_id")] == ["compact"]
