"""demandspark: demand-table analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` parameterised by
column names; the demand recipe is one configuration of them.
"""

from demandspark.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
