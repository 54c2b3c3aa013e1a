"""Registered queries over the given test tables, and the SQL they are compared with."""
