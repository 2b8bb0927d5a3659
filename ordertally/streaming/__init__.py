from ordertally.streaming.jobs import (
    ProgressLog,
    dropped,
    run,
    start_archive,
    start_corrections,
    start_totals,
    wait,
)
from ordertally.streaming.state import carry_over, totals_state

__all__ = [
    "ProgressLog",
    "carry_over",
    "dropped",
    "run",
    "start_archive",
    "start_corrections",
    "start_totals",
    "totals_state",
    "wait",
]
