"""wardline: clinical-operations analytics expressed as Spark DataFrame plans.

Layout
------
sources/    table schemas, constraint catalogue, parquet readers and writers
functions/  column helpers (calendar ranges, exact decimal rounding)
operators/  reusable relational operators (interval join, overlap, pairs,
            hierarchy walk, audits, delete/key propagation, id assignment,
            range-ordered parts and grid joins for skew)
plans/      the reports and rule suites built from the operators, their
            test-table stand-ins with SQL twins
streaming/  the ingest gate that runs the rule suite on a Structured Stream

``python -m wardline`` runs a report or the audit suite from the command line.
"""

__version__ = "0.1.0"
