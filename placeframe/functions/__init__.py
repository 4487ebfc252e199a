from placeframe.functions.columns import (  # noqa: F401
    array_mean,
    bucket_by_membership,
    count_nulls_in,
    date_part_strings,
    is_truthy_number,
    is_truthy_text,
    normalize_text,
    object_key,
    prefix_code,
    safe_cast,
    strip_text,
    threshold_ladder,
)
