"""tripsmith: Spark-native trip-table analytics.

Every operator takes DataFrames and returns DataFrames; the heavy work is
expressed with DataFrame / SQL operators so Catalyst plans it.
"""

__version__ = "0.1.0"
