"""Column-level helpers (all built-in expressions, JVM-side)."""

from snapline.functions.casts import flag, text_timestamp, to_ntz, cycle_date
from snapline.functions.text import iso_text, date_path, json_text, path_parts
from snapline.functions.cadence import Cadence, is_night, effective_interval, local_time
from snapline.functions.status import status_of, clamp_lag, age_seconds, round_tenth

__all__ = [
    "flag", "text_timestamp", "to_ntz", "cycle_date",
    "iso_text", "date_path", "json_text", "path_parts",
    "Cadence", "is_night", "effective_interval", "local_time",
    "status_of", "clamp_lag", "age_seconds", "round_tenth",
]
