"""Spark ML models, rank-based evaluation, anomalies and clusters."""
