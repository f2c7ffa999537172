"""DataFrame operators. All are lazy; none runs a job while the plan is built."""

from marketlens.operators.audit import (
    Rule,
    cleaning_counts,
    cleaning_lines,
    cleaning_report,
    date_coverage,
    key_audit,
    perfect_score_count,
    perfect_score_examples,
    price_facts,
    scope_filter,
    spelling_census,
    threshold_counts,
    value_census,
)
from marketlens.operators.cohorts import cohort_by_label, cohort_vs_market
from marketlens.operators.distribution import (
    band_shares,
    calendar_counts,
    conditional_rate_by_band,
    discount_summary,
    distribution_summary,
    flag_rates_by_band,
)
from marketlens.operators.flags import flag_combinations, flag_rate_by_label, flag_reach
from marketlens.operators.groups import (
    concentration,
    favourite_labels,
    group_sizes,
    keep_members,
    largest_groups,
    members_of_leaders,
    with_total_row,
)
from marketlens.operators.heavy import frequent_labels
from marketlens.operators.labels import (
    explode_labels,
    label_prevalence,
    label_shelf,
    median_vs_pooled,
    mix_shift,
    open_map,
    value_by_label,
)
from marketlens.operators.medians import grouped_medians
from marketlens.operators.objects import (
    inferred_fields,
    key_census,
    open_object,
    typed_parts,
    value_type,
)
from marketlens.operators.quantiles import exact_quantiles
from marketlens.operators.ranking import best_rated, top_k, top_k_per_group

__all__ = [
    "Rule",
    "band_shares",
    "best_rated",
    "calendar_counts",
    "cleaning_counts",
    "cleaning_lines",
    "cleaning_report",
    "cohort_by_label",
    "cohort_vs_market",
    "concentration",
    "conditional_rate_by_band",
    "date_coverage",
    "discount_summary",
    "distribution_summary",
    "exact_quantiles",
    "explode_labels",
    "favourite_labels",
    "flag_combinations",
    "flag_rate_by_label",
    "flag_rates_by_band",
    "flag_reach",
    "frequent_labels",
    "group_sizes",
    "grouped_medians",
    "inferred_fields",
    "keep_members",
    "key_audit",
    "key_census",
    "label_prevalence",
    "label_shelf",
    "largest_groups",
    "median_vs_pooled",
    "members_of_leaders",
    "mix_shift",
    "open_map",
    "open_object",
    "perfect_score_count",
    "perfect_score_examples",
    "price_facts",
    "scope_filter",
    "spelling_census",
    "threshold_counts",
    "top_k",
    "top_k_per_group",
    "typed_parts",
    "value_by_label",
    "with_total_row",
    "value_census",
    "value_type",
]
