"""Reference dimensions as DataFrames, each with an explicit match order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from berthline import fixed_values as fv

ENTITY_SCHEMA = "ord bigint, name string, area string, boat_id bigint"
COORDS_SCHEMA = "boat_id bigint, lat double, lng double"
AREA_SCHEMA = "ord bigint, sub string, main string"
SYNONYM_SCHEMA = "ord bigint, term string, synonyms array<string>"


def _numbered(rows: list[tuple]) -> list[tuple]:
    return [(i, *row) for i, row in enumerate(rows)]


def entity_map(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(ord, name, area, boat_id): built in, or a parquet table of that schema."""
    if path:
        return spark.read.schema(ENTITY_SCHEMA).parquet(path)
    return spark.createDataFrame(_numbered(fv.ENTITY_MAP), ENTITY_SCHEMA)


def boat_coords(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path:
        return spark.read.schema(COORDS_SCHEMA).parquet(path)
    return spark.createDataFrame(fv.BOAT_COORDS, COORDS_SCHEMA)


def area_map(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path:
        return spark.read.schema(AREA_SCHEMA).parquet(path)
    return area_table(spark)


def area_table(spark: SparkSession, areas: list[tuple[str, str]] | None = None) -> DataFrame:
    """(ord, sub, main) of a list of pairs, the built-in one if none is given."""
    rows = fv.AREA_TO_MAIN if areas is None else areas
    return spark.createDataFrame(_numbered(rows), AREA_SCHEMA)


def species_synonyms(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path:
        return spark.read.schema(SYNONYM_SCHEMA).parquet(path)
    return spark.createDataFrame(_numbered(fv.SPECIES_SYNONYMS), SYNONYM_SCHEMA)


def entity_index(entities: DataFrame) -> DataFrame:
    """Per name its map entries (area, boat_id) in the map's order, their number, and the first one's order and boat."""
    return entities.groupBy("name").agg(
        F.count("*").alias("entries"),
        F.transform(
            F.sort_array(F.collect_list(F.struct("ord", "area", "boat_id"))),
            lambda e: F.struct(e["area"].alias("area"), e["boat_id"].alias("boat_id")),
        ).alias("boats"),
        F.min("ord").alias("ord"),
        F.min_by("boat_id", "ord").alias("boat_id"),
    )
