"""The registered queries: a log derived from the ``events`` table, and what runs on it."""
