"""gridloom — gridded reanalysis archive work as Spark DataFrame jobs.

Every operator is a function ``DataFrame -> DataFrame`` (or a column
expression) so that jobs compose with ``df.transform`` and Catalyst sees one
declarative plan.  Subpackages:

* ``functions`` — fixed values, date / path / physics column expressions
* ``sources``   — scans of raw blocks, stores, listings, selection specs
* ``operators`` — manifests, layouts, projections, release logic, aggregates,
                  vertical / spectral / regrid kernels
* ``sinks``     — store templates, region writes, metadata, audit
* ``plans``     — composed jobs (build, update, reconcile, availability)
* ``streaming`` — incremental ingest with Structured Streaming
"""

__version__ = "0.1.0"
