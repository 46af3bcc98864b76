from skymeter.functions.calendar import hour_category, is_weekend, reading_time, season
from skymeter.functions.hashing import hash_bucket
from skymeter.functions.parsing import nan_to_null, parse_decimal_comma, parse_number

__all__ = [
    "hash_bucket",
    "hour_category",
    "is_weekend",
    "nan_to_null",
    "parse_decimal_comma",
    "parse_number",
    "reading_time",
    "season",
]
