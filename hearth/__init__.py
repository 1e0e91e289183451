"""hearth: Spark-first property-valuation analytics.

Every public operator is a ``DataFrame -> DataFrame`` transformation (or a
``fit`` returning a small frozen parameter object plus a pure ``transform``),
built from Spark SQL expressions so Catalyst can prune, push down and fuse it.
"""

__version__ = "0.1.0"
