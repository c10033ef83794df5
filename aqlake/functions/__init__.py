"""Column expressions. All are native: none starts a Python worker."""

from aqlake.functions.json_paths import field
from aqlake.functions.keys import coord_prefix, surrogate_key
from aqlake.functions.labels import argmax_label, prominent_pollutant, register_functions
from aqlake.functions.timeparts import calendar_parts, epoch_to_ntz, local_stamp

__all__ = [
    "argmax_label",
    "calendar_parts",
    "coord_prefix",
    "epoch_to_ntz",
    "field",
    "local_stamp",
    "prominent_pollutant",
    "register_functions",
    "surrogate_key",
]
