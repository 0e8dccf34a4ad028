"""Scans, sinks and the bindings of roles to the test tables."""
