"""Last non-negative balance day of every account as state that daily runs carry forward.

The overdraft rules ask, for each account, for its newest day with a
non-negative balance among the historic partitions of the last 15 days.
Computed from the partitions it reads 15 of them every day, 14 of which the run before
has read already.  :class:`LastPositiveState` keeps the answer between runs:

* a version per run date holds, for each account, the *steps* of its window:
  ``(extraction day, balance day)`` pairs in which a pair is dropped as soon as a
  later extraction has a balance day at least as new.  The first step is
  the answer, the others are what it becomes when the window has moved on; nearly
  always there is one;
* a run takes the newest version before its own date, drops the steps that have left the
  window, reads the partitions that the version has not seen (as a rule one) and merges
  both by account: one read of a partition and one keyed merge;
* which partitions a version has seen is written with it, last of all: a version
  without that list is not complete and is never read.

Hence a re-run starts from the same version as the first run and gives the
same result, a missed day is made up by the next run, and a partition that
arrives late is read when it is there.  A partition rewritten after a version has seen it is
read again by ``run(..., rebuild=True)``, which starts from no version.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..functions import live_contract, snapshot_is
from ..operators.accounts import ACCOUNT_KEY, day_key
from ..sources.newest import delete_folder, folder_exists, folder_partitions

KEY = ["copemk", *ACCOUNT_KEY]


def steps_of(pairs: Column) -> Column:
    """The pairs that no later extraction beats, oldest extraction first (so newest balance day first)."""
    newest_first = F.reverse(F.array_sort(pairs))
    kept = F.aggregate(F.slice(newest_first, 2, F.greatest(F.size(pairs) - 1, F.lit(0))), F.slice(newest_first, 1, 1),
                       lambda acc, x: F.when(x["day"] > F.element_at(acc, -1)["day"], F.concat(acc, F.array(x))).otherwise(acc))
    return F.reverse(kept)


class LastPositiveState:
    """State versions below ``path`` for a window of ``days`` days."""

    def __init__(self, spark: SparkSession, path: str, days: int = P.OVERDRAFT_HISTORY_DAYS):
        self.spark, self.path, self.days = spark, path.rstrip("/"), days

    def _folder(self, kind: str, run: _dt.date) -> str:
        return f"{self.path}/{kind}/run_date={run.isoformat()}"

    def versions(self) -> list[_dt.date]:
        """Run dates of the complete versions, oldest first."""
        seen = f"{self.path}/seen"
        if not folder_exists(self.spark, seen):
            return []
        schema = self.spark.createDataFrame([], "run_date date").schema
        runs = [p["run_date"] for p in folder_partitions(self.spark, seen, schema)]
        return sorted(r for r in runs if folder_exists(self.spark, f"{self._folder('seen', r)}/_SUCCESS"))

    def seen(self, run: _dt.date) -> set[str]:
        """Extraction days that a version has read, at most one for each day of the window."""
        return {r["extractiondate"] for r in self.spark.read.schema("extractiondate string").parquet(self._folder("seen", run)).collect()}

    def run(self, src, as_of: _dt.date, rebuild: bool = False, keep: int = 3) -> list[str]:
        """Make the version of ``as_of``; returns the extraction days that were read.  Older versions than the last ``keep`` go."""
        low, high = day_key(as_of, self.days), day_key(as_of)
        before = [v for v in self.versions() if v < as_of]
        listed = src.partitions("account_balance", {"snapshot": P.SNAPSHOT_HISTORIC})
        window = sorted({p["extractiondate"] for p in listed if low <= p["extractiondate"] <= high})
        known = self.seen(before[-1]) if before and not rebuild else set()
        fresh = [d for d in window if d not in known]
        new = src.account_balance.filter(snapshot_is(P.SNAPSHOT_HISTORIC) & F.col("extractiondate").isin(fresh)
                                         & (F.col("cavt20") >= 0) & live_contract())
        new = new.groupBy(*KEY, F.col("extractiondate").alias("ext")).agg(F.max("fevaig").alias("day")).filter(F.col("day").isNotNull())
        pairs = new.select(*KEY, F.array(F.struct("ext", "day")).alias("pairs"))
        if known:
            old = self.spark.read.schema(self._schema(src)).parquet(self._folder("state", before[-1]))
            inside = F.filter("steps", lambda s: (s["ext"] >= F.lit(low)) & (s["ext"] <= F.lit(high)))
            old = old.select(*KEY, inside.alias("pairs")).filter(F.size("pairs") > 0)
            pairs = pairs.unionByName(old)
        # an account has at most one row per fresh partition and one of the old version
        merged = pairs.groupBy(*KEY).agg(F.flatten(F.collect_list("pairs")).alias("pairs")).select(*KEY, steps_of(F.col("pairs")).alias("steps"))
        state, seen = self._folder("state", as_of), self._folder("seen", as_of)
        delete_folder(self.spark, seen)          # from here until it is written again the version does not count
        merged.write.mode("overwrite").parquet(state)
        days = self.spark.createDataFrame([(d,) for d in window], "extractiondate string").coalesce(1)
        days.write.mode("overwrite").parquet(seen)
        for old_run in self.versions()[:-keep]:
            delete_folder(self.spark, self._folder("seen", old_run))
            delete_folder(self.spark, self._folder("state", old_run))
        return fresh

    def _schema(self, src):
        kinds = {f.name: f.dataType.simpleString() for f in src.account_balance.schema.fields}
        keys = ", ".join(f"{c} {kinds[c]}" for c in KEY)
        return f"{keys}, steps array<struct<ext: string, day: date>>"

    def view(self, src, as_of: _dt.date) -> DataFrame:
        """Rows of ``accounts.last_positive_day(balances, as_of)`` from the version of ``as_of``."""
        if as_of not in self.versions():
            raise LookupError(f"no complete state of {as_of}: run() it first")
        rows = self.spark.read.schema(self._schema(src)).parquet(self._folder("state", as_of))
        return rows.select(*KEY, F.col("steps")[0]["day"].alias("MAX_DIA_SALDO_POSITIVO"))
