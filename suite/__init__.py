"""Registered queries and their check SQL, by topic."""
