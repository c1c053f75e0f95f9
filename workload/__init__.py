"""Registered queries: doclake operators over the benchmark tables, each with its SQL twin."""
