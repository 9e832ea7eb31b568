"""quarry: reusable, Spark-native data jobs.

Every public job is a plain function ``DataFrame -> DataFrame`` (or takes a
``SparkSession`` plus table frames).  Nothing runs at import time and no job
pulls a data-sized result to the driver.
"""

__version__ = "0.1.0"
