"""Compositions: marts, features, reliability index, decisions, serving queries."""
