"""Facility-reliability analytics as Spark DataFrame operators.

Sub-packages: ``functions`` (column expressions), ``sources`` (readers, ledger,
contracts, sinks), ``operators`` (table transforms, joins, windows, ranking,
quality checks, exploration), ``plans`` (marts, features, index, decisions,
serving queries) and ``learning`` (Spark ML models, evaluation, anomalies).
"""
