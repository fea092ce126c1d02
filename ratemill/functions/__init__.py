from .keys import (
    external_id,
    fill_level_template,
    invoice_date_text,
    item_key,
    item_key_text,
    level_key,
    match_key,
    state_flag,
    strip_text,
)
from .sql import register_functions

__all__ = [
    "external_id",
    "fill_level_template",
    "invoice_date_text",
    "item_key",
    "item_key_text",
    "level_key",
    "match_key",
    "register_functions",
    "state_flag",
    "strip_text",
]
