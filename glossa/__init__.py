"""glossa: localization tables and batch translation as Spark DataFrame plans.

Modules are grouped the way a Spark job is read:

* ``sources``   -- readers: locale documents (binaryFile), translation logs (CSV/Parquet),
  archive listings, and the fixture views derived from the driver tables.
* ``functions`` -- column expressions (Python ``strip``/``str`` fidelity, JSON quoting,
  locale path predicates, model/provider reconciliation).
* ``operators`` -- DataFrame -> DataFrame steps: extraction, resume, pair dedup, batch
  numbering, prompts, inference, reply parsing, apply, gates, QA reports.
* ``plans``     -- the composed pipeline and the registered queries.
* ``sinks``     -- log/preview/document writers and the package manifest.
* ``streaming`` -- the incremental (Structured Streaming) form of the pipeline.
"""

__version__ = "0.1.0"
