"""Value functions behind the strategies, as Spark SQL expressions.

Each takes expressions as text and returns one. Text is shared by DataFrame
projections and the registered SQL functions, and a wide policy is planned in
one call per table rather than one per operator of every expression.
"""
