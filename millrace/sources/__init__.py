"""Readers and writers: streams, files, the change log and the catalog."""
