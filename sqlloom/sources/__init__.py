"""Readers and writers for JSON lines, CSV, schema folders, manifests and sharded output."""
