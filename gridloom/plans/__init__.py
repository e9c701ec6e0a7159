"""Runnable queries over the test tables and the SQL that each is compared with."""
