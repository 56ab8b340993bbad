"""Operators: routing (C1), country tagging (C2), time columns (C3),
sessions (C5) and insights (C6-C10)."""
