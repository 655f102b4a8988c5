"""Readers, sinks and the test views shaped like clinic records."""
