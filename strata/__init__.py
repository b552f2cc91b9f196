"""Layered, incremental ingestion of event logs on Spark.

A raw layer appends every record of a topic-like log; a refined layer parses the
JSON payloads, keeps the newest record per key and upserts it into a current-state
table.
"""
