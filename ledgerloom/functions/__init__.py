"""Column builders. All are built-in Spark expressions: no Python runs per row."""

from .people import (
    above_limit,
    age_on,
    birthday_hash,
    bare_mobile,
    clean_email,
    email_domain,
    format_birthday,
    is_mobile,
    layout_of,
    membership_id,
    parse_birthday,
    has_suffix,
)
from .names import core_name, core_tokens, first_name, last_name, name_tokens
from .stamps import run_stamp_of

__all__ = [
    "above_limit", "age_on", "bare_mobile", "birthday_hash", "clean_email", "core_name",
    "core_tokens", "email_domain", "first_name", "format_birthday", "has_suffix", "is_mobile", "last_name",
    "layout_of", "membership_id", "name_tokens", "parse_birthday", "run_stamp_of",
]
