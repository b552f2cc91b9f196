"""Column expressions. Everything here is a native Spark expression."""

from strata.functions.epoch import epoch_text_to_timestamp
from strata.functions.json_text import is_json

__all__ = ["epoch_text_to_timestamp", "is_json"]
