"""Column-expression helpers (all JVM-side, codegen friendly)."""

from emporia.functions.time import (  # noqa: F401
    epoch_ms,
    event_time,
    local_date,
    local_time,
    local_time_str,
    ntz_epoch_ms,
    seconds_of_day,
)
from emporia.functions.text import (  # noqa: F401
    absolute_url,
    growth_rate,
    percent_text,
    region_parts,
)
