"""Job options (roles, weights, currencies), one frozen object per job."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class JobSpec:
    # money
    target_currency: str = "EUR"
    second_currency: str = "USD"
    base_year: int = 1998              # price year the amounts are deflated to
    period_start: dt.date = dt.date(1992, 1, 1)   # rate / index tables cover this range
    period_end: dt.date = dt.date(2002, 12, 1)
    # matching
    top_n: int = 10
    w_cosine: float = 0.7
    w_overlap: float = 0.3
    w_breadth: float = 0.0
    min_score: float | None = None
    # uncertainty: total factor = attr + pct80_weight * pct80
    pct80_weight: float = 0.8
    # clustering
    n_clusters: int = 12
    reps_per_cluster: int = 10
    rep_text_chars: int = 400
    # batching
    token_budget: int = 120_000
    batch_rows: int = 1_500
    basis: str = "money"               # 'money' | 'physical'
    roles: dict = field(default_factory=dict)

    def months_in_period(self) -> int:
        return ((self.period_end.year - self.period_start.year) * 12
                + self.period_end.month - self.period_start.month + 1)
