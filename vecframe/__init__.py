"""vecframe: day-partitioned vector and text tables on Spark DataFrames.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects; the heavy
work is expressed with the DataFrame API (scans, joins, aggregates, windows)
or, where a dense matrix product is the natural kernel, with Arrow batches
inside ``mapInArrow`` / ``applyInPandas`` tasks that Spark partitions.
"""

from vecframe.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
__version__ = "0.1.0"
