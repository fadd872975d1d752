"""Training-data pipeline operators.

One module per operator; :mod:`lanekit.llm.queries` holds the thin registered
queries and their SQL. Nothing else in the library imports this package.
"""
