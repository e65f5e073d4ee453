from pyspark.sql import functions as F


def all_queries(view):
    """Every row of a small collection as a query vector ``(qid, vec)``."""
    return view.select(F.col("id").alias("qid"), F.col("value").alias("vec"))
