"""Operators Spark lacks or that need a skew-safe shape; composed from built-ins."""

from emporia.operators.cumulate import assign_panes, cumulative_measure, cumulative_top_n  # noqa: F401
from emporia.operators.ranking import joined_list, latest_by, top_n  # noqa: F401
from emporia.operators.joins import ip_region_join, null_safe_on, prev_day_join, with_dimension  # noqa: F401
from emporia.operators.sequence import transitions  # noqa: F401
from emporia.operators.generators import explode_keywords, explode_split  # noqa: F401
