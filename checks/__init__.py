"""Registered queries: views over the given tables, the queries, and the SQL to compare with."""
