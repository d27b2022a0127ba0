"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from daystream.functions.dates import (age_years, day_of, dt_of, epoch_ms_of, hr_of)
from daystream.functions.routing import fact_topic, op_code
from daystream.functions.values import is_blank, to_long

__all__ = ["age_years", "day_of", "dt_of", "epoch_ms_of", "hr_of",
           "fact_topic", "op_code", "is_blank", "to_long"]
