"""quire: daily, categorised briefings from large mail and web-page tables on Spark.

Every operator is a DataFrame -> DataFrame (or Column -> Column) function so that
Catalyst plans the whole job; Python runs only inside the pluggable model step.
"""

from quire.params import Params

__all__ = ["Params"]
