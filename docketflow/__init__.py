"""Case-flow statistics on Spark DataFrames."""

from docketflow.functions.codes import CHILD_CODES, EXIT_CODES, NO_EXIT, SEVERAL_EXITS
from docketflow.functions.dates import day_between, parse_dmy, seconds_between, trunc_day
from docketflow.operators.candidates import (
    child_event_exits,
    child_reassignment_exits,
    exit_candidates,
    own_case_exits,
)
from docketflow.operators.cleanup import drop_matching, keep_matching, keep_since
from docketflow.operators.exits import last_exit_event, latest_per_case
from docketflow.operators.lookup import with_court, with_status_code
from docketflow.operators.process_log import log_seconds
from docketflow.plans.chambers import (
    CHAMBERS,
    ChamberPeriod,
    chamber_periods,
    chamber_statistics,
    periods_frame,
    requests_per_period,
)
from docketflow.plans.incremental import ExitLedger
from docketflow.plans.runs import (
    RunOutcome,
    has_previous_period,
    pending_periods,
    run_chambers,
)
from docketflow.sources.layout import open_by_case, write_by_case
from docketflow.sources.store import (
    RunStore,
    append_error,
    append_errors,
    read_errors,
    read_statistics,
    save_statistics,
)
from docketflow.sources.tables import SCHEMAS, CaseTables, read_case_tables, read_table

__all__ = [
    "CHAMBERS", "CHILD_CODES", "EXIT_CODES", "NO_EXIT", "SCHEMAS", "SEVERAL_EXITS",
    "CaseTables", "ChamberPeriod", "ExitLedger", "RunOutcome", "RunStore", "append_error",
    "append_errors", "chamber_periods",
    "chamber_statistics", "child_event_exits", "child_reassignment_exits", "day_between",
    "drop_matching", "exit_candidates", "has_previous_period", "keep_matching", "keep_since",
    "last_exit_event", "latest_per_case", "log_seconds", "open_by_case", "own_case_exits", "parse_dmy",
    "pending_periods", "periods_frame", "read_case_tables", "read_errors", "read_statistics",
    "read_table", "requests_per_period", "run_chambers", "save_statistics", "seconds_between",
    "trunc_day", "with_court", "with_status_code", "write_by_case",
]
