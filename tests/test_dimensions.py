"""Maintained current dimensions against the full build, through loads, reloads and withdrawals."""

import random
import shutil
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from gondola.operators.dims import current
from gondola.plans import dimensions
from gondola.plans.sinks import replace_days

FIRST = date(2026, 1, 1)
KEYS = ("a", "b")
SCHEMA = "a string, b string, name string, n int, fecha_vigencia date"


def day(n):
    return FIRST + timedelta(days=n)


class Lake:
    def __init__(self, spark, path):
        self.spark, self.path, self.state = spark, str(path / "dim"), str(path / "state")
        self.days = {}
        self.schema = spark.createDataFrame([], SCHEMA).schema

    def load(self, **days):
        """dN=rows: replaces the date."""
        rows = [(*r, day(int(d[1:]))) for d, found in days.items() for r in found]
        self.days |= {int(d[1:]): found for d, found in days.items()}
        replace_days(self.spark.createDataFrame(rows, SCHEMA), self.path)

    def withdraw(self, *numbers):
        for n in numbers:
            del self.days[n]
            shutil.rmtree(f"{self.path}/fecha_vigencia={day(n)}")

    def maintained(self, **options):
        return sorted(map(tuple, dimensions.maintain(self.spark, self.path, self.schema, KEYS, self.state, **options).collect()), key=str)

    def full(self):
        return sorted(map(tuple, current(self.spark.read.schema(self.schema).parquet(self.path), KEYS).collect()), key=str)

    def damage(self, n):
        """The files of a date keep their names and can no longer be read."""
        for file in __import__("pathlib").Path(f"{self.path}/fecha_vigencia={day(n)}").glob("*"):
            file.unlink() if file.name.endswith(".crc") else file.write_bytes(b"damaged")


def test_equal_to_the_full_build_through_random_changes(spark, tmp_path):
    rng, lake = random.Random(5), Lake(spark, tmp_path)

    def rows():
        return [(rng.choice("xyz") if rng.random() < 0.9 else None, rng.choice("123"), rng.choice("pqr"), rng.choice((1, 2, None))) for _ in range(rng.randint(1, 9))]

    lake.load(d0=rows(), d1=rows(), d2=rows())
    assert lake.maintained() == lake.full()
    for step in range(9):
        for _ in range(rng.choice((1, 1, 2))):
            if rng.random() < 0.4 and len(lake.days) > 2:
                lake.withdraw(rng.choice(sorted(lake.days)[-3:]))
            else:
                lake.load(**{f"d{rng.choice([step + 3, *lake.days])}": rows()})
        assert lake.maintained() == lake.full(), step


def test_a_run_reads_only_the_dates_that_changed(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.load(**{f"d{i}": [("x", "1", f"name {i}", i), ("y", "1", "same", 0)] + ([("z", "1", "late", i)] if i > 3 else []) for i in range(5)})
    lake.maintained()
    for n in (0, 1, 2, 3, 4):
        lake.damage(n)
    lake.load(d5=[("x", "1", "newest", 5)])
    assert [r[:3] for r in lake.maintained()] == [("x", "1", "newest"), ("y", "1", "same"), ("z", "1", "late")]
    lake.load(d5=[("x", "1", "reloaded", 5), ("y", "1", "too", 5)])
    assert [r[:3] for r in lake.maintained()] == [("x", "1", "reloaded"), ("y", "1", "too"), ("z", "1", "late")]
    lake.withdraw(5)
    assert [r[:3] for r in lake.maintained()] == [("x", "1", "name 4"), ("y", "1", "same"), ("z", "1", "late")]
    assert lake.maintained() == lake.maintained()  # nothing changed: the state alone
    lake.withdraw(4)  # x and y lost both of their rows: their history is read, which is damaged here
    with pytest.raises(Exception, match="(?i)parquet|damaged|footer"):
        lake.maintained()


def test_a_key_that_lost_both_rows_is_looked_up_again(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.load(**{f"d{i}": [("x", None, f"name {i}", i)] for i in range(6)}, d9=[("q", "1", "other", 1)])
    lake.maintained()
    lake.withdraw(5)
    lake.maintained()
    lake.withdraw(4)
    assert lake.maintained() == lake.full() == [("q", "1", "other", 1, day(9)), ("x", None, "name 3", 3, day(3))]
    lake.withdraw(0, 1, 2, 3)
    assert lake.maintained() == lake.full() == [("q", "1", "other", 1, day(9))]
    lake.withdraw(9)
    assert lake.maintained() == []
    lake.load(d2=[("x", None, "back", 2)])
    assert lake.maintained() == lake.full()


def test_a_failed_run_leaves_the_version_before(spark, tmp_path, monkeypatch):
    lake = Lake(spark, tmp_path)
    lake.load(d0=[("x", "1", "old", 0)])
    before = lake.maintained()
    lake.load(d1=[("x", "1", "new", 1)])
    with monkeypatch.context() as patched:
        patched.setattr(dimensions.Folder, "write_text", lambda *_: (_ for _ in ()).throw(OSError("no space")))
        with pytest.raises(OSError, match="no space"):
            lake.maintained()
    assert dimensions._version(dimensions.Folder(spark, lake.state))[0] == 1 and before[0][2] == "old"
    assert lake.maintained() == lake.full()
    assert lake.maintained(full=True) == lake.full()


def test_a_hot_key_sends_three_rows_a_task(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.load(d0=[("x", "1", str(i), i) for i in range(2000)])
    df = dimensions._best_of_dates(spark.read.schema(lake.schema).parquet(lake.path), KEYS, 3)
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()
    assert df.select(F.col("name")).collect()[0][0] == "0"
