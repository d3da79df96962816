"""Scans, sinks and the fixture views."""
