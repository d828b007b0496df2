"""Readers, sinks, file manifests, the ingest ledger and small dimensions."""
