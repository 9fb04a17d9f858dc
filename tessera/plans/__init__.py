"""Query compositions, size-checked broadcasts and plan inspection helpers."""
