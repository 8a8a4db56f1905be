"""Sinks of the panel library."""
