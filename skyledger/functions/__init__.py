"""Column functions; every one stays inside Catalyst."""

from .keys import md5_id, md5_key, route, route_ws, uuid5
from .text import (
    blank_to_null,
    clip,
    default,
    dirty_token,
    first_present,
    is_blank,
    like_any,
    strip,
    strip_terminal,
    strip_terminal_feature,
    token_replace_first,
    token_trim_first,
    trim_lower,
    trim_upper,
)
from .values import (
    abs_value,
    bool_words,
    calendar,
    date_trunc_cast,
    extract_hour,
    flag,
    floor_at,
    is_date,
    is_number,
    iso_z,
    json_is_object,
    json_text,
    now,
    ratio,
    row_json,
    try_date,
    try_number,
)
from .vocab import map_vocab

__all__ = [name for name in dir() if not name.startswith("_")]
