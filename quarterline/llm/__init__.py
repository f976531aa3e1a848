"""Training-data operators: scoring, deduplication, mixing, archives and token files.

Nothing outside this folder imports it. ``queries`` registers the plans.
"""
