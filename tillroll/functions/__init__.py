from tillroll.functions.columns import (  # noqa: F401
    MONTH_NAMES,
    UNKNOWN_PRODUCT,
    NO_DESCRIPTION,
    WEEKDAY_NAMES,
    list_repr,
    money_sum,
    month_year_label,
    truncate_text,
    weekday_name,
    year_month_label,
)
