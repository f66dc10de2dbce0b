"""Training-data operators: scoring, deduplication, formatting, filtering, decontamination, packing.

Every operator takes and returns DataFrames; Python runs only inside tasks, over Arrow batches, on rows that
Spark has partitioned. ``catalog`` holds the registered queries.
"""
