from strata.operators.aggregates import (
    carrier_delay_spread,
    carrier_summary,
    daily_event_counts,
    distinct_keys,
    row_count,
    rows_per_key,
    total,
)
from strata.operators.conform import conform, conform_events, conform_flights, faults
from strata.operators.digests import (
    differing_buckets,
    differing_rows,
    merge_digests,
    require_same_rows,
    row_digests,
)
from strata.operators.drift import (
    column_drift,
    file_schemas,
    require_one_schema,
    schema_versions,
)
from strata.operators.profile import describe, null_profile, profile
from strata.operators.quality import (
    lineage,
    quality_profile,
    reconcile,
    require_reconciled,
)
from strata.operators.provenance import (
    gold_lineage,
    merge_provenance,
    provenance,
    require_lineage,
    trace,
)
from strata.operators.ranking import rank_by, top_by
from strata.operators.sketches import merge_profiles, profile_parts, read_profile
from strata.operators.states import (
    merge_states,
    partial_states,
    state_deviation,
    state_mean,
    state_sum,
)

__all__ = [
    "column_drift",
    "file_schemas",
    "merge_profiles",
    "profile_parts",
    "read_profile",
    "require_one_schema",
    "schema_versions",
    "differing_buckets",
    "differing_rows",
    "gold_lineage",
    "merge_digests",
    "merge_provenance",
    "merge_states",
    "partial_states",
    "provenance",
    "require_lineage",
    "require_same_rows",
    "row_digests",
    "state_deviation",
    "state_mean",
    "state_sum",
    "trace",
    "carrier_delay_spread",
    "carrier_summary",
    "conform",
    "conform_events",
    "conform_flights",
    "daily_event_counts",
    "describe",
    "distinct_keys",
    "faults",
    "lineage",
    "null_profile",
    "profile",
    "quality_profile",
    "rank_by",
    "reconcile",
    "require_reconciled",
    "row_count",
    "rows_per_key",
    "top_by",
    "total",
]
