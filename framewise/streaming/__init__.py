"""framewise streaming."""
