"""DataFrame -> DataFrame operators: ingest, staging, quality, marts, reports, privacy."""
