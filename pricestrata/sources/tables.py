"""Typed reads and writes of the stored tables, and the partitioned fact sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestrata.schemas import schema


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(schema(name)).parquet(f"{root}/{name}")


def read_jdbc(spark: SparkSession, name: str, options: dict[str, str]) -> DataFrame:
    """The same table from a database; give partitionColumn and bounds for a parallel read."""
    columns = ", ".join(f.simpleString().replace(":", " ") for f in schema(name))
    return spark.read.format("jdbc").options(**{"customSchema": columns, **options}).load()


def conformed(rows: DataFrame, name: str) -> DataFrame:
    """The declared columns of a table in their declared types; one that ``rows`` lacks is null, one that is not declared
    is an error, and so is a value that its type cannot hold."""
    declared = schema(name)
    unknown = sorted(set(rows.columns) - set(declared.names))
    if unknown:
        raise ValueError(f"{name} declares no column {', '.join(unknown)}")
    return rows.select(
        *(
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in declared
        )
    )


def write_table(rows: DataFrame, root: str, name: str) -> None:
    """Replace a stored table."""
    conformed(rows, name).write.mode("overwrite").parquet(f"{root}/{name}")


def append_facts(facts: DataFrame, path: str) -> None:
    """Append facts partitioned by day; the day column is what every fact join prunes on."""
    dated = facts.withColumn("observed_date", F.col("observed_at").cast("date"))
    dated.write.mode("append").partitionBy("observed_date").parquet(path)


def overwrite_days(facts: DataFrame, path: str) -> None:
    """Replace only the days present in ``facts``."""
    dated = facts.withColumn("observed_date", F.col("observed_at").cast("date"))
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("observed_date")
        .parquet(path)
    )
