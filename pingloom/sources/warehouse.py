"""Full refresh of a warehouse table: staged files and a bulk load, or rows over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter


def stage(df: DataFrame, folder: str) -> None:
    """Write the rows as Parquet where the warehouse can read them; every task writes its own file."""
    df.write.mode("overwrite").parquet(folder)


def load_statements(table: str, folder: str, columns: list[str], credentials: str | None = None) -> list[str]:
    """SQL that replaces a table's rows by staged files, for one transaction of the warehouse."""
    names = ", ".join('"' + c.replace('"', '""') + '"' for c in columns)
    quoted = folder.replace("'", "''")
    access = f" {credentials}" if credentials else ""
    return [f"TRUNCATE TABLE {table}", f"COPY {table} ({names}) FROM '{quoted}'{access} FORMAT AS PARQUET"]


def staged_refresh(df: DataFrame, table: str, folder: str, credentials: str | None = None) -> list[str]:
    """Stage the rows and return the statements that load them."""
    stage(df, folder)
    return load_statements(table, folder, df.columns, credentials)


def refresh_options(url: str, table: str, connections: int, batch_rows: int = 10_000, **extra: str) -> dict[str, str]:
    """Writer options that empty the table but keep its definition, then load it over as many connections as it allows."""
    return {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
        **extra,
    }


def refresh_writer(df: DataFrame, url: str, table: str, connections: int, **extra: str) -> DataFrameWriter:
    """A writer ready to ``save()``; credentials come from the caller's ``extra`` options."""
    return df.write.format("jdbc").mode("overwrite").options(**refresh_options(url, table, connections, **extra))


def refresh(df: DataFrame, url: str, table: str, connections: int, **extra: str) -> None:
    refresh_writer(df, url, table, connections, **extra).save()
