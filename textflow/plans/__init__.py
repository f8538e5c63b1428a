"""Named query plans (the ``queries()`` / ``oracle_sql()`` catalogue)."""
