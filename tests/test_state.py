"""Load marks and carried balance state against what they replace."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rumbo.operators import accounts
from rumbo.plans import drafts, overdraft
from rumbo.sources.marks import LoadMarks
from rumbo.sources.newest import Partition
from rumbo.sources.standins import AS_OF
from rumbo.sources.warehouse import WarehouseSources, standin_warehouse
from rumbo.streaming.balance_state import LastPositiveState, steps_of

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def src(spark):
    return standin_warehouse(spark, SF).build_all()


def rows(df):
    return sorted(map(str, df.collect()))


class Until:
    """The sources as they are on a day: only partitions extracted by then, some of them missing."""

    def __init__(self, src, day, missing=()):
        self.src, self.day, self.missing = src, day, set(missing)

    def partitions(self, name, equal=None):
        return [p for p in self.src.partitions(name, equal)
                if p["extractiondate"] <= self.day.strftime("%Y%m%d") and p["extractiondate"] not in self.missing]

    @property
    def account_balance(self):
        return self.src.account_balance.filter((F.col("extractiondate") <= self.day.strftime("%Y%m%d"))
                                               & ~F.col("extractiondate").isin(*self.missing, ""))


def test_state_equals_the_window_on_every_day(spark, src, tmp_path):
    """Twenty days: one run twice, one day without a run, one partition that comes two days late."""
    state = LastPositiveState(spark, str(tmp_path / "state"))
    days = [AS_OF - dt.timedelta(days=n) for n in range(19, -1, -1)]
    late = days[11].strftime("%Y%m%d")
    for i, day in enumerate(days):
        if i == 6:                                   # no run: the next one reads two partitions
            continue
        view = Until(src, day, [late] if i in (11, 12) else [])
        read = state.run(view, day)
        want = rows(accounts.last_positive_day(view.account_balance, day).select("copemk", *accounts.ACCOUNT_KEY, "MAX_DIA_SALDO_POSITIVO"))
        assert rows(state.view(view, day)) == want and len(want) > 50, day
        if 0 < i < 10:
            assert len(read) == (2 if i == 7 else 1), (day, read)
        if i == 9:                                   # a re-run reads the same partition and changes nothing
            assert state.run(view, day) == read and rows(state.view(view, day)) == want
        if i == 13:
            assert late in read
    assert state.versions() == days[-3:]             # older versions are gone
    # rebuilt from all partitions of the window
    assert len(state.run(src, AS_OF, rebuild=True)) >= 14 and rows(state.view(src, AS_OF)) == want


def test_an_unfinished_version_is_not_read(spark, src, tmp_path):
    state = LastPositiveState(spark, str(tmp_path / "state"))
    first, second = AS_OF - dt.timedelta(days=3), AS_OF - dt.timedelta(days=2)
    state.run(src, first)
    state.run(src, second)
    os.remove(tmp_path / "state" / "seen" / f"run_date={second}" / "_SUCCESS")
    assert state.versions() == [first]
    with pytest.raises(LookupError):
        state.view(src, second)
    state.run(src, AS_OF)
    assert rows(state.view(src, AS_OF)) == rows(accounts.last_positive_day(src.account_balance, AS_OF).select(
        "copemk", *accounts.ACCOUNT_KEY, "MAX_DIA_SALDO_POSITIVO"))


def test_overdraft_master_from_state(spark, src, tmp_path):
    state = LastPositiveState(spark, str(tmp_path / "state"))
    state.run(src, AS_OF)
    a = overdraft.overdraft_master(src, AS_OF)
    b = overdraft.overdraft_master(src, AS_OF, history=state.view(src, AS_OF))
    assert rows(a) == rows(b) and a.count() > 0


def test_steps_drop_what_a_later_extraction_beats(spark):
    pairs = [("20240103", dt.date(2024, 1, 3)), ("20240101", dt.date(2024, 1, 9)), ("20240102", dt.date(2024, 1, 3)), ("20240104", dt.date(2024, 1, 1))]
    df = spark.createDataFrame([(1, pairs), (2, pairs[:1])], "k int, pairs array<struct<ext: string, day: date>>")
    got = {r["k"]: [tuple(s) for s in r["s"]] for r in df.select("k", steps_of(F.col("pairs")).alias("s")).collect()}
    assert got == {1: [pairs[1], pairs[0], pairs[3]], 2: pairs[:1]}


# ---- marks -----------------------------------------------------------------------

def test_marks_are_appended_once(spark, tmp_path):
    marks = LoadMarks(spark, str(tmp_path / "marks"))
    d = lambda n: dt.date(2024, 1, n)
    assert marks.newest("a", d(31)) is None and marks.read().count() == 0
    marks.append("a", d(10), "20240109", 5)
    marks.append("a", d(11), "20240110", 6)
    marks.append("b", d(11), "20240101")
    before = rows(marks.read())
    marks.append("a", d(11), "20240110", 6)          # the load of the 11th runs again
    assert rows(marks.read()) == before and len(before) == 3
    assert marks.newest("a", d(31)) == "20240110" and marks.newest("a", d(10)) == "20240109" and marks.newest("a", d(9)) is None
    assert marks.newest("a", d(31), at_most="20240109") == "20240109"
    assert {tuple(r) for r in marks.control(d(31)).collect()} == {("a", "20240110"), ("b", "20240101")}


def test_drafts_read_their_control_table(spark, src, tmp_path, monkeypatch):
    """With marks the drafts list no partition and take no maximum; a mark held back holds the draft back."""
    marks = LoadMarks(spark, str(tmp_path / "marks"))
    as_of = dt.date(2024, 2, 1)
    newest = {label: src.newest(*where, as_of.strftime("%Y%m%d")) for label, where in drafts.CONTROL_SOURCES.items()}
    marks.append_all([(label, dt.date(2024, 1, 31), day, None) for label, day in newest.items()])
    with_marks = WarehouseSources(spark, src.root, src.schemas, marks)
    want = rows(drafts.young_retention_draft(src, as_of))
    monkeypatch.setattr(WarehouseSources, "newest", lambda *a, **k: pytest.fail("asked for partitions"))
    assert rows(drafts.young_retention_draft(with_marks, as_of)) == want != []
    marks.append(drafts.BOARD, dt.date(2024, 1, 31), "20231231")      # the load had come only so far
    older = drafts.young_retention_draft(with_marks, as_of)
    assert rows(older) != want and older.count() == len(want)


def test_partitions_behave_as_values():
    p = Partition((("a", 1), ("b", "x")), "/p")
    assert p["a"] == 1 and p["b"] == "x" and p == Partition((("a", 1), ("b", "x")), "/p")
