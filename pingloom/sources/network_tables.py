"""The relational tables: routes, stations, vehicles, people."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pingloom import schemas


@dataclass(frozen=True)
class Network:
    estacion: DataFrame
    ruta: DataFrame
    estacion_por_ruta: DataFrame
    bus: DataFrame
    tipo_bus: DataFrame
    persona: DataFrame
    tipo_persona: DataFrame
    tipo_documento: DataFrame

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str) -> Network:
        return cls(**{
            name: spark.read.schema(schemas.struct(ddl)).parquet(f"{folder}/{name}")
            for name, ddl in schemas.NETWORK.items()
        })

    @classmethod
    def from_jdbc(
        cls, spark: SparkSession, url: str, db_schema: str, tables: dict[str, dict[str, str]] | None = None, **options: str
    ) -> Network:
        """Tables of a database. ``tables`` has further options by table, such as those of :func:`parallel`."""
        return cls(**{
            name: spark.read.format("jdbc").options(**jdbc_options(name, url, db_schema, tables, **options)).load()
            for name in schemas.NETWORK
        })


def parallel(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Options that read one table over several connections, cut evenly between two values of a column."""
    return {
        "partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions),
    }


def jdbc_options(
    name: str, url: str, db_schema: str, tables: dict[str, dict[str, str]] | None = None, **options: str
) -> dict[str, str]:
    """Reader options of one table."""
    unknown = set(tables or {}) - set(schemas.NETWORK)
    if unknown:
        raise ValueError(f"no such tables: {sorted(unknown)}")
    return {"url": url, "dbtable": f"{db_schema}.{name}", **options, **(tables or {}).get(name, {})}


def stations(network: Network) -> DataFrame:
    """The five columns map and lookups use; the rest is never read."""
    return network.estacion.select("id", "nombre", "latitud", "longitud", "tipo")
