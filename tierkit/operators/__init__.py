from tierkit.operators.snapshot import (  # noqa: F401
    latest_snapshot, max_stamp, newer_than)
from tierkit.operators.dedup import first_per_key  # noqa: F401
from tierkit.operators.aggregate import audit_columns, group_count, row_count  # noqa: F401
from tierkit.operators.enrich import enrich_left, unique_reference  # noqa: F401
from tierkit.operators.project import apply_rules  # noqa: F401
from tierkit.operators.guards import filter_eq, is_empty, preview  # noqa: F401
