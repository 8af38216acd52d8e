"""orrery — applied-analytics operators as Spark DataFrame / Structured Streaming jobs.

Subpackages: ``sources`` (tables, files, sinks), ``functions`` (Column functions),
``operators`` (DataFrame operators), ``plans`` (registered queries and their SQL
oracles), ``streaming`` (the streaming hops). See README.md.
"""

__version__ = "0.1.0"
