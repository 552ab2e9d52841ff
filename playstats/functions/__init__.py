from playstats.functions.cleaning import clean_frame, clean_text, split_numeric, to_number
from playstats.functions.text import full_name
from playstats.functions.timeparts import (add_time_parts, epoch_ms_to_start_time, floor_to_second,
                                           ntz_to_epoch_ms, time_part_columns)

__all__ = ["clean_frame", "clean_text", "split_numeric", "to_number", "full_name",
           "add_time_parts", "epoch_ms_to_start_time", "floor_to_second", "ntz_to_epoch_ms",
           "time_part_columns"]
