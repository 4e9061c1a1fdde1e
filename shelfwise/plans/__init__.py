"""Runnable queries: each operator over the test tables, with the SQL that checks it."""
