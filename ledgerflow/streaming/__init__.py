from ledgerflow.streaming.ingest import olap_stream, sales_stream, start_olap_sink  # noqa: F401
