"""Operators: DataFrame in, DataFrame out."""

from lakesteps.operators.dedup import keep_first, keep_last, keep_one, priority_union  # noqa: F401
from lakesteps.operators.keys import dense_key, lookup_dim  # noqa: F401
from lakesteps.operators.merge import (  # noqa: F401
    backfill, merge_new_first, new_or_changed, overwrite_window, reprocess_window,
)
from lakesteps.operators.quality import check, missing_columns, not_null, unique  # noqa: F401
from lakesteps.operators.records import (  # noqa: F401
    explode_json_records, extract_pattern_records, extract_records, json_field,
)
from lakesteps.operators.reshape import (  # noqa: F401
    explode_days, explode_lateral, explode_months, outer_join_all, pivot_last, unpivot_long,
    zip_arrays_to_rows,
)
from lakesteps.operators.rollup import (  # noqa: F401
    class_counts, count_by, distinct_values, high_water, left_join_all, rollup_spec, union_all,
    union_distinct,
)
from lakesteps.operators.scaling import minmax_scale, scenarios, with_global_stats  # noqa: F401
from lakesteps.operators.scoring import (  # noqa: F401
    map_label, score_text, word_list_label, word_list_scorer,
)
from lakesteps.operators.select import (  # noqa: F401
    keep_containing, newest, newest_first, project, require, require_text, take_until_marker,
    unique_columns, with_lineage, with_processed_at,
)
from lakesteps.operators.terms import term_matches  # noqa: F401
