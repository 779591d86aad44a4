from .calendar import (crop_month_label, crop_month_num, crop_year_label, crop_year_start, shift_months,
                       with_calendar, with_crop_date, with_unit, year_month_key)
from .scalars import growth_vs, hs4, null_words_to_null, pct_change, share_pct, zero_to_null

__all__ = ["crop_month_label", "crop_month_num", "crop_year_label", "crop_year_start", "shift_months", "with_calendar",
           "with_crop_date", "with_unit", "year_month_key", "growth_vs", "hs4", "null_words_to_null", "pct_change",
           "share_pct", "zero_to_null"]
