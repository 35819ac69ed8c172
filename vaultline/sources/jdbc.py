"""Tables of a warehouse database, read in parallel over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str, table: str, user: str, password: str, key: str | None = None,
    bounds: tuple[int, int] | None = None, partitions: int = 1, fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options. With a numeric ``key`` and its ``bounds`` the table is read in ranges of the key.

    Without both one task would read the whole table, so ``partitions`` above one is refused then.
    """
    if not password:
        raise ValueError("a database password is required")
    if partitions > 1 and (key is None or bounds is None):
        raise ValueError("partitions need a key and its bounds")
    options = {"url": url, "dbtable": table, "user": user, "password": password, "fetchsize": str(fetch_size)}
    if key is not None and bounds is not None:
        options |= {
            "partitionColumn": key,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, **arguments) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**arguments)).load()
