"""K3: publish a table to a database over JDBC (overwrite).

Each task opens its own connection and inserts its partition in batches, so
the write is as parallel as ``num_partitions`` allows (the database is usually
the limit; cap it there).  Overwrite drops and recreates the table unless
``truncate`` is set, which keeps the table definition and its grants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, *, driver: str | None = None,
               user: str | None = None, password: str | None = None, mode: str = "overwrite",
               truncate: bool = False, num_partitions: int | None = None,
               batchsize: int | None = None, extra: dict | None = None) -> None:
    w = df.write.mode(mode).format("jdbc").option("url", url).option("dbtable", table)
    opts = {"driver": driver, "user": user, "password": password,
            "numPartitions": num_partitions, "batchsize": batchsize}
    if truncate:
        opts["truncate"] = "true"
    for k, v in {**opts, **(extra or {})}.items():
        if v is not None:
            w = w.option(k, str(v))
    w.save()
