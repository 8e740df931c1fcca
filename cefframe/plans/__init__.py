"""Query catalogue and plan inspection helpers."""
