"""tessera: Spark-native operators for medallion refinement, data-quality gating,
feature engineering, model sweeps and registry, contract-checked scoring and
operational rollups over request logs.

Layout: ``sources`` (files and datasets), ``functions`` (Column expressions),
``operators`` (DataFrame-in/DataFrame-out steps), ``streaming`` (Structured
Streaming jobs), ``plans`` (the jobs and the registered queries).
"""

__version__ = "0.1.0"
