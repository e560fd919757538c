"""JDBC source and sink.

Connection settings come from the caller (options or properties); nothing
is hard-coded.  Reads can be split over ``num_partitions`` ranges of a
numeric column so a large table is not pulled through one connection.
Filters and projections on the returned DataFrame are pushed into the
database query by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, url: str, table: str, properties: dict | None = None,
         partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
         num_partitions: int | None = None, query: str | None = None) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url)
    r = r.option("query", query) if query else r.option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions or 1))
    return r.load()


def write(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None,
          batch_size: int = 1000) -> None:
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()


def upsert_batch(df: DataFrame, url: str, table: str, key: list[str], properties: dict | None = None,
                 stage_suffix: str = "_stage") -> None:
    """Replay-safe keyed upsert for a micro-batch: rows of ``df`` replace the
    rows with the same key, so a retried batch leaves the same table.

    The executors write the batch to a staging table; two set-based
    statements then move it into ``table`` (no row passes the driver).
    """
    props = dict(properties or {})
    cols = df.columns

    # Spark-side: delete-then-insert by key through a staging table.
    stage = f"{table}{stage_suffix}"
    write(df, url, stage, mode="overwrite", properties=props)
    # Spark's JDBC writer creates quoted (case-preserving) column names.
    conds = " AND ".join(f'{table}."{k}" = s."{k}"' for k in key)
    collist = ", ".join(f'"{c}"' for c in cols)
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conn = jvm.java.sql.DriverManager.getConnection(url, _jprops(jvm, props))
    try:
        conn.setAutoCommit(False)
        st = conn.createStatement()
        st.executeUpdate(f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {stage} s WHERE {conds})")
        st.executeUpdate(f"INSERT INTO {table} ({collist}) SELECT {collist} FROM {stage}")
        st.close()
        conn.commit()
    finally:
        conn.close()


def _jprops(jvm, props: dict):
    p = jvm.java.util.Properties()
    for k, v in props.items():
        if k not in ("driver",):
            p.setProperty(k, str(v))
    return p
