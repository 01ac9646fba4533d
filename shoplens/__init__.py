"""shoplens: retail click analytics as PySpark DataFrame / Structured Streaming jobs.

Every analysis is a function from DataFrame(s) to a DataFrame; nothing runs until an
action is called, so Catalyst sees each job as one plan (pushdown, pruning, partial
aggregation, top-k limits).
"""

__version__ = "0.1.0"
