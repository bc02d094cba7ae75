from stratiform.operators.checks import (
    Check,
    QualityError,
    assert_no_rows,
    enforce,
    run_checks,
)
from stratiform.operators.joins import fanout_left_join
from stratiform.operators.lineage import with_lineage
from stratiform.operators.smoke import SmokeResult, smoke_check, smoke_check_source, smoke_frame

__all__ = [
    "Check",
    "QualityError",
    "SmokeResult",
    "assert_no_rows",
    "enforce",
    "fanout_left_join",
    "run_checks",
    "smoke_check",
    "smoke_check_source",
    "smoke_frame",
    "with_lineage",
]
