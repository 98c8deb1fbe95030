"""DataFrame -> DataFrame operators (import from the submodules, or from here)."""

from .aging import invoice_aging, receivable_aging
from .aggregates import count_when, group_status, level_rollup, ordered_distinct_text, sum_if
from .calendar import calendar_attributes
from .changes import (
    apply_overrides,
    flag_soft_deletes,
    month_end_snapshot,
    reconcile_counts,
    replace_date_window,
    scd1_upsert,
)
from .conform import best_keyword_match, classify_by_prefix, conform_parties, union_tagged
from .dedup import latest_by_priority, latest_per_key
from .ledger import balances_with_history, period_balances, spread_label
from .lookup import code_lookup, lookup_many, scalar_lookup, star_join
from .marts import entity_summary, invoice_tax, mart_diff
from .numbering import running_number, sequence_in_parent, sequence_number
from .pivots import dynamic_pivot, milestone_pivot, static_pivot

__all__ = [name for name in dir() if not name.startswith("_")]
