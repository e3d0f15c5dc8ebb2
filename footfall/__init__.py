"""footfall: user-behaviour analytics operators for Spark.

Every operator is a function from DataFrame to DataFrame.  Batch operators are
declared with built-in expressions so that Catalyst plans them; the forms that
Spark streaming cannot express with built-ins live in ``footfall.streaming``.
"""

__version__ = "0.1.0"
