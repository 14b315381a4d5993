"""tessera: tabular preparation, profiling and regression comparison on Spark.

Layout: ``functions`` (native column expressions), ``sources`` (tables in,
report frames out), ``operators`` (DataFrame -> DataFrame steps), ``plans``
(end-to-end runs and the query catalog), ``llm`` (training-data operators,
a subpackage of its own that nothing else here imports).
"""

from tessera.spec import PrepResult, RunReport, TableSpec, derive_roles

__all__ = ["PrepResult", "RunReport", "TableSpec", "derive_roles"]
__version__ = "0.1.0"
