from ledgerspark.streaming.ingest import (  # noqa: F401
    KAFKA_SCHEMA,
    await_streams,
    file_source,
    start_kafka_streams,
    start_stream,
)
