"""tallyhouse: daily market statistics (deals and listings) as Spark DataFrame jobs.

The public entry points are the job plans in :mod:`tallyhouse.plans`; the
building blocks live in :mod:`tallyhouse.operators` (grouped metrics),
:mod:`tallyhouse.functions` (column expressions), :mod:`tallyhouse.sources`
and :mod:`tallyhouse.sinks` (I/O).
"""

__version__ = "0.1.0"
