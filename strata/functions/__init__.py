from .dates import calendar_columns, date_key, shift_days, shift_seconds
from .expressions import case_map, guarded_ratio, mask_hash, mask_prefix, threshold_ladder
from .hashing import hash_bucket, row_hash, stable_id

__all__ = [
    "calendar_columns", "date_key", "shift_days", "shift_seconds",
    "case_map", "guarded_ratio", "mask_hash", "mask_prefix", "threshold_ladder",
    "hash_bucket", "row_hash", "stable_id",
]
