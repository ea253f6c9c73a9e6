"""Scans of folders and JSON documents, and the dataset sinks."""
