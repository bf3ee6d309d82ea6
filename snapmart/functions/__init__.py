from snapmart.functions.scalars import (  # noqa: F401
    DURATION_PATTERN, datekey, duration_part, iso_duration, month_name, month_name_of,
    null_or_text_null, quarter_label, safe_ratio, split_list, topic_names,
    url_tail, to_date_safe,
)
