from tierkit.sinks.files import export_csv, land_json, overwrite_table  # noqa: F401
from tierkit.sinks.layout import cluster_layout  # noqa: F401
