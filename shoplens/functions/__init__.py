"""Column expressions (all built-in Spark functions, so they stay in codegen)."""

from shoplens.functions.time import (  # noqa: F401
    bucket_start, day_of, epoch_ms_of_ntz, instant_of, local_time_of, time_label,
)
from shoplens.functions.ids import id_list  # noqa: F401
