"""Readers, change detection and sinks."""
