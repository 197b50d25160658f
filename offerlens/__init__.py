"""Job-offer analytics as PySpark DataFrame operators.

Subpackages: ``functions`` (Column builders), ``operators`` (reusable
DataFrame-to-DataFrame steps), ``sources`` (readers, snapshots), ``plans``
(staging, marts, reports, extraction), ``streaming`` (incremental ingest) and
``bindings`` (the same operators over the benchmark tables, with their SQL).
"""
