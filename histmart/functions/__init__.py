from histmart.functions.clean import (  # noqa: F401
    VALID_SP_RATINGS,
    blank_to_null,
    blanks_to_null,
    format_phone,
    low_grade,
    nameplate_tags,
    normalise_code,
    null_to_empty,
    parse_pts,
    parse_yyyymmdd,
    present,
    safe_ratio,
    to_decimal,
    valid_rating,
)
