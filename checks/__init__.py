"""Registered queries, their SQL twins, and the comparison of both."""
