"""kindred — a Spark-native audience look-alike engine.

Visitor page views are joined with content, category, sentiment,
subscription and label tables, folded into one feature row per visitor,
scored with Spark ML and compared across populations. All data work is
DataFrame / Spark SQL; there are no Python UDFs in the engine.
"""

__version__ = "0.1.0"
