"""DataFrame operators (filters, joins, windows, aggregates, generators,
projections)."""

from lanekit.operators.aggregates import (  # noqa: F401
    category_sums, distinct_keys, grouped_having, present_count, sum_or_zero)
from lanekit.operators.filters import (  # noqa: F401
    OPEN_END, all_of, apply_conditions, current_rows, half_open, has_prefix, in_list)
from lanekit.operators.generators import explode_values, flat_map_lines  # noqa: F401
from lanekit.operators.joins import (  # noqa: F401
    enrich, enrich_chain, keep_matching, keep_missing)
from lanekit.operators.projections import derive_month, project, zero_when  # noqa: F401
from lanekit.operators.windows import first_per_group, rank_rows  # noqa: F401
