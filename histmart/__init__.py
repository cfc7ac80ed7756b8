"""histmart: history-warehouse operators on Spark DataFrames.

Versioned (type 2) dimensions, point-in-time lookups, change-data merges,
running and rolling fact tables, data-quality alerts and audit checks, all
expressed with the DataFrame / SQL API so Catalyst plans the work.
"""

from histmart.session import get_spark, checkpoint_dir  # noqa: F401

END_OF_TIME = "9999-12-31"
