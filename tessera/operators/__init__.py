"""DataFrame → DataFrame operators, usable with ``df.transform``. None of them collects data."""
