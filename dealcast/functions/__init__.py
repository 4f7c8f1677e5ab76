"""Column-level functions (all built-in Spark expressions, no Python UDFs)."""

from dealcast.functions.text import (  # noqa: F401
    AD_WORDS, BOGO_WORDS, DATE_FORMATS, GWP_WORDS, age_to_date, ad_flag, contains_any,
    discount_off, gwp_flag, parse_posted_date, pct_off,
)
from dealcast.functions.calendar import nth_weekday, weekday_name, weekend_flag  # noqa: F401
from dealcast.functions.draws import uniform_draw  # noqa: F401
