from gaugeflow.functions.cells import cell_map, int_cell, long_cell, text_cell
from gaugeflow.functions.channels import as_floats, first_channel, float_mean
from gaugeflow.functions.keys import (
    bucket_floor,
    day_text,
    days_between,
    group_key,
    reverse_time,
    row_key,
    salt_prefix,
    time_bucket,
)
from gaugeflow.functions.text import second_text, time_text, values_text

__all__ = [
    "as_floats",
    "bucket_floor",
    "cell_map",
    "day_text",
    "days_between",
    "first_channel",
    "float_mean",
    "group_key",
    "int_cell",
    "long_cell",
    "reverse_time",
    "row_key",
    "salt_prefix",
    "second_text",
    "text_cell",
    "time_bucket",
    "time_text",
    "values_text",
]
