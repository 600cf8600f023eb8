"""DataFrame operators: each takes and returns DataFrames. Those that store their input or look at its
size say so; the others run no action."""

from labwh.operators.attendance import active_by_window, pair_in_out, within_validity
from labwh.operators.bitmaps import day_bitmaps, dense_ids, distinct_by_unit, merge_states
from labwh.operators.common import keyed_join, null_safe_join
from labwh.operators.dims import (
    in_any,
    lookup_levels,
    membership,
    not_in,
    scaffold,
    split_by_membership,
    with_children,
)
from labwh.operators.flags import add_flags, add_measures, flag_exists, key_flags
from labwh.operators.jsonlog import counts_by_field, extract_json, json_field, parsed, payload, variant_field
from labwh.operators.keys import (
    dense_rank_within,
    latest_per_key,
    latest_values,
    rank_within,
    sum_once,
)
from labwh.operators.measures import (
    attach_totals,
    band_columns,
    conditional_measures,
    count_if,
    label_list,
    measure_columns,
    running_total,
    split_amounts,
    sum_if,
    unpivot_metrics,
    with_shares,
)
from labwh.operators.merge import merge_latest, outer_merge, upsert_rows
from labwh.operators.periods import (
    active_in_period,
    active_months,
    cumulative_distinct,
    cumulative_sums,
    cutoff_of,
    entity_periods,
    in_months,
    latest_up_to,
    merged_spans,
    month_shift,
    period_series,
    with_month_shift,
)
from labwh.operators.ranges import By, join_ranked, numbered_rows, rank_by_ranges
from labwh.operators.heavy import heavy_keys
from labwh.operators.spread import spread_join
from labwh.operators.rules import all_met, covered_status, met_if, score_rules

__all__ = [n for n in dir() if not n.startswith("_")]
