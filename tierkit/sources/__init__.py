from tierkit.sources.snapshots import newest_snapshot, read_snapshots, stamp_column  # noqa: F401
from tierkit.sources.reference import read_reference_csv  # noqa: F401
from tierkit.sources.pages import paged_records  # noqa: F401
from tierkit.sources.tables import literal_rows, read_table, table_bytes  # noqa: F401
