"""framewise sources."""
