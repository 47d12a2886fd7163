"""Run-time metrics of the rules: warnings about inputs that make a rule empty.

A rule as written may quietly give nothing: scores of another day than the
thresholds' newest date, a control table without a row, an insurer that the code map does not name.
Inside a :class:`RuleMetrics` block the operators count such rows while the
journey's own query runs (:func:`watch`, ``DataFrame.observe``: no extra job, no change to
the result), or ask for one row of a partition before it (:func:`note_if_empty`, where Spark may drop the
frame from the plan and its count with it); afterwards :meth:`RuleMetrics.report` logs one warning for each
count that is out of line.  Outside of a block nothing is observed.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation

LOG = logging.getLogger("rumbo.rules")

_ACTIVE: ContextVar[RuleMetrics | None] = ContextVar("rumbo_rule_metrics", default=None)


class RuleMetrics:
    """Collects the observations of one journey run: ``with RuleMetrics() as m: ...write...; m.report()``."""

    def __init__(self):
        self._observed: list[tuple[str, Observation, Callable[[dict], str | None]]] = []
        self._found: list[str] = []
        self._token = None

    def __enter__(self) -> RuleMetrics:
        self._token = _ACTIVE.set(self)
        return self

    def __exit__(self, *exc) -> None:
        _ACTIVE.reset(self._token)

    def add(self, df: DataFrame, name: str, warn: Callable[[dict], str | None], metrics: dict[str, Column]) -> DataFrame:
        observation = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        self._observed.append((name, observation, warn))
        return df.observe(observation, *[c.alias(n) for n, c in metrics.items()])

    def note(self, message: str) -> None:
        self._found.append(message)

    def values(self) -> dict[str, list[dict]]:
        """What the run has counted, by metric."""
        out: dict[str, list[dict]] = {}
        for name, observation, _ in self._observed:
            got = _reached(observation)
            if got is not None:
                out.setdefault(name, []).append(got)
        return out

    def warnings(self) -> list[str]:
        said = list(self._found)
        for _, observation, warn in self._observed:
            got = _reached(observation)
            message = warn(got) if got is not None else None
            if message is not None:
                said.append(message)
        return list(dict.fromkeys(said))

    def report(self) -> list[str]:
        """Log the warnings, each once, and return them."""
        found = self.warnings()
        for message in found:
            LOG.warning(message)
        return found


def _reached(observation: Observation) -> dict | None:
    """The observed values; None if no action has reached them yet (``get`` would wait for one), or if Spark has
    dropped the frame from the plan as a side of a join that turned out empty."""
    done = observation._jo.future().isCompleted() and observation._jo.getRow().schema() is not None
    return observation.get if done else None


def watch(df: DataFrame, name: str, warn: Callable[[dict], str | None], **metrics: Column) -> DataFrame:
    """``df``, observed when a :class:`RuleMetrics` block is open."""
    active = _ACTIVE.get()
    return df if active is None else active.add(df, name, warn, metrics)


def note(message: str) -> None:
    """A warning that is known while the plan is built."""
    active = _ACTIVE.get()
    if active is not None:
        active.note(message)


def note_if_empty(df: DataFrame, message: str) -> None:
    """A warning if ``df`` has no row; looks for one row of it, and only inside a block."""
    if _ACTIVE.get() is not None and df.isEmpty():
        note(message)
