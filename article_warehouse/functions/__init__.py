from article_warehouse.functions.numbers import to_long
from article_warehouse.functions.text import char_count, text_or_empty, word_count
from article_warehouse.functions.times import date_key, instant, to_utc, utc_naive, utc_now

__all__ = [
    "char_count",
    "date_key",
    "instant",
    "text_or_empty",
    "to_long",
    "to_utc",
    "utc_naive",
    "utc_now",
    "word_count",
]
