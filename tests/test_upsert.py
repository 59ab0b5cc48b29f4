"""The folded weather table: the same answer at any moment."""

import random
from datetime import datetime, timedelta

import pytest
from rows import rows_of

from streamtide import schemas
from streamtide.plans import upsert
from streamtide.session import drop_folder

BEGIN = datetime(2024, 1, 1)


def observations(spark, seed, n=120, days=4):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        at = BEGIN + timedelta(minutes=rng.randrange(days * 24 * 60), microseconds=rng.randrange(10**6))
        rows.append((at.strftime("%Y%m%d%H"), f"p{rng.randrange(3)}", rng.choice(["Rain", "Sun", None]), 1.0 * seed, rng.random(), at))
    return spark.createDataFrame(rows, schemas.WEATHER_OBS)


def expected(*batches):
    best = {}
    for r in (r for b in batches for r in b.collect()):
        key = r.hour_key, r.place
        best[key] = max(best.get(key, (datetime.min,)), (r.obs_ts, r.main, r.wind, r.temp), key=lambda x: x[0])
    return sorted((k, p, m, w, t, at) for (k, p), (at, m, w, t) in best.items())


def answer(spark, root, **more):
    return sorted(tuple(r) for r in upsert.latest(spark, root, **more).select("hour_key", "place", "main", "wind", "temp", "obs_ts").collect())


def test_equal_before_during_and_after_folds(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert answer(spark, root) == [] and upsert.fold(spark, root, "2024-01-03") == 0
    one, two, late = (observations(spark, seed) for seed in (1, 2, 3))
    upsert.append(one, root, "one")
    upsert.append(two, root, "two")
    assert answer(spark, root) == expected(one, two)
    seen = []
    with monkeypatch.context() as patched:
        patched.setattr(upsert, "swept", lambda *_: seen.append(answer(spark, root)))
        assert upsert.fold(spark, root, "2024-01-03") == 1
    assert seen == [expected(one, two)]  # log and snapshot both there
    upsert.append(late, root, "late")
    assert answer(spark, root) == expected(one, two, late)
    assert upsert.fold(spark, root, "2024-01-04") == 2
    assert answer(spark, root) == expected(one, two, late)
    assert rows_of(upsert.log(spark, root).select("day").distinct()) == [(datetime(2024, 1, 4).date(),)]
    folded = upsert.snapshots(spark, root, upsert.current(spark, root)[1])
    assert folded.count() == folded.select("hour_key", "place").distinct().count()
    assert sorted(x.name for x in (tmp_path / "snapshots" / "version=1").glob("day=*")) == []
    of_days = answer(spark, root, days=("2024-01-02", "2024-01-02"))
    assert of_days == [r for r in expected(one, two, late) if r[0].startswith("20240102")] and of_days


@pytest.mark.parametrize("lost", ["manifest/fold=1", "manifest/fold=1/_SUCCESS"])
def test_a_fold_that_failed_is_done_again(spark, tmp_path, lost):
    root = str(tmp_path)
    one, two = observations(spark, 4), observations(spark, 5)
    upsert.append(one, root, "one")
    upsert.fold(spark, root, "2024-01-09", sweep=False)
    drop_folder(spark, f"{root}/{lost}")
    upsert.append(two, root, "two")
    assert answer(spark, root) == expected(one, two)
    assert upsert.fold(spark, root, "2024-01-09") == 2
    assert answer(spark, root) == expected(one, two) and upsert.log(spark, root).isEmpty()


def test_a_batch_written_again_after_its_fold_changes_nothing(spark, tmp_path):
    root, one = str(tmp_path), observations(spark, 6)
    upsert.append(one, root, "one")
    upsert.fold(spark, root, "2024-01-03")
    upsert.append(one, root, "one")
    assert answer(spark, root) == expected(one)


def test_other_days_are_not_read_by_a_fold(spark, tmp_path):
    root = str(tmp_path)
    upsert.append(observations(spark, 7), root, "one")
    upsert.fold(spark, root, "2024-01-09")
    kept = {x: x.stat().st_mtime_ns for x in (tmp_path / "snapshots").rglob("*.parquet") if "day=2024-01-01" not in str(x)}
    upsert.append(observations(spark, 8, days=1), root, "two")
    upsert.fold(spark, root, "2024-01-09")
    assert kept and all(x.stat().st_mtime_ns == at for x, at in kept.items())
    assert {r.version for r in upsert.current(spark, root)[1].collect()} == {1, 2}
