"""Row and column operators of the table jobs."""

from tablewright.operators.filters import where_equals, where_sql
from tablewright.operators.preview import preview, schema_report
from tablewright.operators.projection import project_positions, select_all
from tablewright.operators.windows import ranked_running_total

__all__ = [
    "preview",
    "project_positions",
    "ranked_running_total",
    "schema_report",
    "select_all",
    "where_equals",
    "where_sql",
]
