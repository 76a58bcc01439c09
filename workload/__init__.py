"""Appraisal-shaped views over the test tables, the registered queries, and
the SQL they are checked against."""
