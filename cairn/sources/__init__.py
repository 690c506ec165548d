"""Readers and writers: file discovery, schema-declared scans, sinks and manifests."""
