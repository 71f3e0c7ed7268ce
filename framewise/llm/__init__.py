"""Training-data operators: scoring, dedup, decontamination, formatting, scans.

Nothing else in the library imports this subpackage; it may use the general
helpers of ``framewise.session``.
"""
