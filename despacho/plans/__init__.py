"""The extracts, their delivery and the bookkeeping of runs."""
