"""Column-level helpers: exact rounding, time measures, presentation casts."""

from salesmart.functions.numeric import cents, money, present, round_ratio
from salesmart.functions.time import calendar_days, elapsed_days, late_flag

__all__ = ["cents", "money", "present", "round_ratio", "calendar_days", "elapsed_days", "late_flag"]
