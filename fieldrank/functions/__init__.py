"""Column -> Column functions. Everything here is a built-in Spark expression (JVM side,
no Python UDF), so it composes inside select/agg and stays in the codegen'd stages."""

from fieldrank.functions.text import *  # noqa: F401,F403
from fieldrank.functions.scoring import *  # noqa: F401,F403
