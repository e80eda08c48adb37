"""Governance tables for a data lake, computed as Spark jobs.

Four jobs (storage inventory, SQL grants, query-log usage, access policies) and
the list, map, schema, batching and loading operators around them. Every job is
a function from DataFrame to DataFrame.
"""
