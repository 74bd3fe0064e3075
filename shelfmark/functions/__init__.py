"""Expressions the reports share, as Spark SQL text.

Every function takes and returns SQL fragments (column names or expressions). They compose
without a round trip to the JVM per operator, and a whole select list is parsed and analysed
in one call; Catalyst sees the same built-in expressions as with the Column API.
"""
