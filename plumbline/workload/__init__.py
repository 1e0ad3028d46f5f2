"""Queries on the driver's tables, and the SQL each of them must agree with.

A domain recipe needs a domain table. Each one is *derived from the given tables* by a
staging SELECT that both engines run; nulls, sentinels, dirty text and orphans are put in
by expression. What is tested is everything after that: the recipe against plain SQL.
"""
