"""Typed records out of the feeds' rows."""
