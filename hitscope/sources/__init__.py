"""Scans (S1-S4), the test-table adapter and day landing."""
