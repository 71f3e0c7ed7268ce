"""framewise operators."""
