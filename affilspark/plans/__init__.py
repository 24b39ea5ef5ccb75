"""Whole workflows, the registered queries and their oracles."""
