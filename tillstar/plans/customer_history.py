"""Type-2 history of the customer dimension, kept as immutable parts.

Versions that a run closes are one folder that no later run touches; open versions are one folder that the next run
replaces. So a run reads and writes the open versions and what it closes, however long the history is.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.operators.history import VALID_TO, open_versions, scd2_step
from tillstar.sources.commits import Commit, CommittedTable

# What the history carries and which changes open a new version.
TRACKED = [
    "customer_key", "customer_id", "country_code", "first_order_date", "last_order_date",
    "total_orders", "total_spend", "avg_order_value", "customer_segment", "churn_risk",
]
CHECKED = ["customer_segment", "churn_risk", "total_orders", "total_spend"]
KEY = "customer_id"

#: Layout column of the parts; not a column of the history.
STATE = "_state"
OPEN, CLOSED = "open", "closed"
RUN_AT = "run_at"


def active(customers: DataFrame, churned: str = "high") -> DataFrame:
    """Customers who have not left by the churn rule: the tracked set of a history that only follows active ones."""
    return customers.where(F.col("churn_risk") != churned)


def _is_open(folder: str) -> bool:
    return folder.endswith(f"/{STATE}={OPEN}")


def record_run(table: CommittedTable, customers: DataFrame, run_at: dt.datetime) -> Commit:
    """Continue the history with the customers of a run, or begin it.

    Runs follow each other in time: one dated at or before the last would end versions before they begin.
    """
    last = table.latest()
    incoming = customers.select(*TRACKED)
    if last is None:
        versions = open_versions(incoming, KEY, run_at)
    elif run_at <= dt.datetime.fromisoformat(last.notes[RUN_AT]):
        raise ValueError(f"a run at {run_at} can't follow the run at {last.notes[RUN_AT]}")
    else:
        versions = scd2_step(table.read(last, _is_open), incoming, KEY, CHECKED, run_at)
    state = F.when(F.col(VALID_TO).isNull(), OPEN).otherwise(CLOSED)
    return table.write(
        versions.withColumn(STATE, state), (STATE,), keep=lambda f: not _is_open(f), hidden=(STATE,), arrange=False, base=last,
        extra={RUN_AT: run_at.isoformat()},
    )
