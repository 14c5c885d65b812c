"""Column helpers shared by every plan."""

from cohortlake.functions.calendar import as_ntz, month_number, period_start
from cohortlake.functions.numeric import half_up, ratio

__all__ = ["as_ntz", "half_up", "month_number", "period_start", "ratio"]
