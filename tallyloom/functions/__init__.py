"""Column functions. All of them are built-in Spark expressions; none is a Python UDF."""

from tallyloom.functions.scalars import *  # noqa: F401,F403
