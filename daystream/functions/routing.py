"""Change-type mapping and output topic names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Change types and their one-letter operation codes (exact,
# case-sensitive; any other type is dropped).
OP_CODES = {
    "bootstrap-insert": "I",
    "insert": "I",
    "update": "U",
    "delete": "D",
}

# Output topic suffix and the five log topics.
TOPIC_SUFFIX = "20220629"
PAGE_TOPIC = "DWD_PAGE_LOG_TOPIC_20220629"
DISPLAY_TOPIC = "DWD_PAGE_DISPLAY_TOPIC_20220629"
ACTION_TOPIC = "DWD_PAGE_ACTION_TOPIC_20220629"
START_TOPIC = "DWD_START_LOG_TOPIC_20220629"
ERROR_TOPIC = "DWD_ERROR_LOG_TOPIC_20220629"
#: Not in the original job (which lets a bad record fail the task).
DEAD_LETTER_TOPIC = "DWD_DEAD_LETTER_20220629"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def op_code(change_type) -> Column:
    """Change type -> 'I' / 'U' / 'D', NULL for anything else."""
    c = _col(change_type)
    out = None
    for k, v in OP_CODES.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return out


def fact_topic(table, op, suffix: str = TOPIC_SUFFIX) -> Column:
    """DWD_<UPPER(table)>_<op>_<suffix>."""
    return F.concat_ws("_", F.lit("DWD"), F.upper(_col(table)), _col(op), F.lit(suffix))
