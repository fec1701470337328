"""Incremental variants of the batch jobs on file-source streams."""
