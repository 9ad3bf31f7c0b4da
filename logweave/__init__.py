"""logweave: data jobs over logs, text, baskets and time series on Spark.

Subpackages: ``sources`` (readers/writers), ``functions`` (column expressions and
the fixed log formats), ``operators`` (DataFrame -> DataFrame operators),
``plans`` (composite jobs and the registered queries), ``streaming``.
"""

__version__ = "0.1.0"

from .session import cut_lineage, ensure_checkpoint_dir, get_spark, read_table  # noqa: F401,E402
