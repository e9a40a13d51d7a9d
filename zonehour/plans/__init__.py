"""Composite jobs (``pipeline``), the query catalogue and its SQL oracle."""
