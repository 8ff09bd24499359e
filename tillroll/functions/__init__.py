from tillroll.functions.expr import (  # noqa: F401
    clamp_non_negative,
    concat_strict,
    exact_sum,
    file_extension,
    file_base_name,
    file_identity,
    round_half_away,
    time_text,
    to_double,
    to_long_rounded,
    ts_from_date_and_time,
    tz_offset_text,
)
