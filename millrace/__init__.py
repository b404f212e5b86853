"""millrace: standardising semi-structured records with Spark SQL expressions.

Records are DataFrames: one column per field, plus a ``_meta`` struct. Every operator is a
function from DataFrame to DataFrame built from Spark SQL expressions.
"""

from millrace.operators import *  # noqa: F401,F403
from millrace.operators import __all__ as _operators
from millrace.plans import *  # noqa: F401,F403
from millrace.plans import __all__ as _plans
from millrace.sources import *  # noqa: F401,F403
from millrace.sources import __all__ as _sources

__all__ = [*_operators, *_plans, *_sources]
