"""Readers, landing ledger, contracts and sinks."""
