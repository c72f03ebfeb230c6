"""Queries: operators applied to the tables of one folder, with their SQL counterparts."""
