"""Relational operators shared by the jobs."""
