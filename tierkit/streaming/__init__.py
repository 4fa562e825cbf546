from tierkit.streaming.incremental import stream_bronze_to_silver  # noqa: F401
