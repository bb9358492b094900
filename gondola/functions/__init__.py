"""Column -> Column building blocks; everything here stays inside JVM code generation."""

from gondola.functions.casts import blank_to_null, clean_id, soft_double, soft_float, soft_int, soft_long, strip
from gondola.functions.dates import business_date, footer_date, is_footer, weekday_name
from gondola.functions.measures import exact_avg, exact_sum, percent_change, price_decimal
from gondola.functions.text import CATEGORY_RULES, OTHER_CATEGORY, categorize_product, clean_description

__all__ = [
    "CATEGORY_RULES",
    "OTHER_CATEGORY",
    "blank_to_null",
    "business_date",
    "categorize_product",
    "clean_description",
    "clean_id",
    "exact_avg",
    "exact_sum",
    "footer_date",
    "is_footer",
    "percent_change",
    "price_decimal",
    "soft_double",
    "soft_float",
    "soft_int",
    "soft_long",
    "strip",
    "weekday_name",
]
