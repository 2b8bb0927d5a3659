from ordertally.operators.current import archive_current, corrected_current, kpi_current
from ordertally.operators.copies import dedup
from ordertally.operators.customers import enrich, unmatched
from ordertally.operators.sizes import fits_broadcast, is_small_lookup
from ordertally.operators.totals import (
    corrected_totals,
    facts_of,
    totals_by_category,
    totals_by_source_state,
)
from ordertally.operators.versions import restated, valid_at

__all__ = [
    "archive_current",
    "corrected_current",
    "corrected_totals",
    "dedup",
    "enrich",
    "facts_of",
    "fits_broadcast",
    "is_small_lookup",
    "kpi_current",
    "restated",
    "totals_by_category",
    "totals_by_source_state",
    "unmatched",
    "valid_at",
]
