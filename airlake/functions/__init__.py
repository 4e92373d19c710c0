from airlake.functions.aqi import (aqi, na_to_int, na_to_zero, prominent, prominent_pollutant,
                                   sub_index_count, with_aqi)
from airlake.functions.keys import surrogate_key
from airlake.functions.time import calendar, feed_ts, landing_stamp, to_ntz

__all__ = [
    "aqi", "na_to_int", "na_to_zero", "prominent", "prominent_pollutant", "sub_index_count",
    "with_aqi", "surrogate_key", "calendar", "feed_ts", "landing_stamp", "to_ntz",
]
