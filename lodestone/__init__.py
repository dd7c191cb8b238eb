"""lodestone: a Spark-native daily market-data pipeline.

Layers: bronze JSON documents -> validated silver Parquet -> typed staging
frames -> one daily fact table -> dashboard queries. Every step is a
function from DataFrame(s) to DataFrame; nothing is collected to the driver.
"""

__version__ = "0.1.0"
