from smelter.operators.keys import surrogate_key
from smelter.operators.project import project, spread_dates
from smelter.operators.staging import scratch_path, scratch_until_done, stage
from smelter.operators.tables import finish_replacements, preview, write_table, write_tables

__all__ = [
    "finish_replacements",
    "preview",
    "project",
    "scratch_path",
    "scratch_until_done",
    "spread_dates",
    "stage",
    "surrogate_key",
    "write_table",
    "write_tables",
]
