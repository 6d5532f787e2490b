"""Counters of the stream job, observed while a batch does its own work (F8)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation

from postlytics.operators.promotion import FUNNEL, funnel_columns

Report = Callable[[int, dict[str, int]], None]


@dataclass
class FunnelTotals:
    """Running totals over the batches of a run, and the counters of the last batch.

    Only the last batch can be repeated; its second report replaces the first.
    """

    total: dict[str, int] = field(default_factory=lambda: dict.fromkeys(FUNNEL, 0))
    last: dict[str, int] = field(default_factory=dict)
    batch_id: int | None = None

    def __call__(self, batch_id: int, counts: dict[str, int]) -> None:
        if batch_id == self.batch_id:
            self.total = {name: n - self.last[name] for name, n in self.total.items()}
        self.total = {name: n + counts[name] for name, n in self.total.items()}
        self.batch_id, self.last = batch_id, counts


def observe_funnel(marked: DataFrame) -> tuple[DataFrame, Observation]:
    """Marked posts that count themselves while the next action reads them.

    The rows must be read whole by that action, without a shuffle behind them: then each task
    counts once, also where an executor is lost. `Observation.get` waits for that action.
    """
    funnel = Observation("funnel")
    return marked.observe(funnel, *funnel_columns()), funnel
