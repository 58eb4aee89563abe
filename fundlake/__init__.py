"""fundlake: Spark-native medallion analytics for private-fund data.

Bronze CSV drops are typed into Silver tables, aggregated into Gold
dashboard tables and served through Spark SQL views.  Every operator is a
lazy ``DataFrame -> DataFrame`` function that takes column names as
parameters; nothing is collected to the driver.
"""

__version__ = "0.1.0"
