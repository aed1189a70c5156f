from .cleaning import age_band, clean_category, shifted_log, to_number
from .keys import hash_order, row_noise
from .scalars import (
    case_label, epoch_seconds, fixed_date, mean_rounded, merge_maps, on_date, threshold_flag, to_float,
)

__all__ = [
    "age_band", "case_label", "clean_category", "epoch_seconds", "fixed_date", "hash_order",
    "mean_rounded", "merge_maps", "on_date", "row_noise", "shifted_log", "threshold_flag", "to_float",
    "to_number",
]
