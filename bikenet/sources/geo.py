"""Neighbourhood polygons from GeoJSON.

A collection is one JSON document, often in one large file, which Spark's reader leaves to one task.
Here a file is read by byte ranges (:mod:`bikenet.sources.ranges`), so that many tasks share it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bikenet import schema as S
from bikenet.functions.conic import Conic
from bikenet.functions.geometry import to_wgs84
from bikenet.sources.files import arrow_knows
from bikenet.sources.ranges import BLOCK_BYTES, nested_objects


_FEATURE = T.StructType([
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),
    ])),
])
#: A feature is an element of an array of the document: two brackets are open before it.
_OPEN_BEFORE = 2


def read_neighborhoods(
    spark: SparkSession, path: str, epsg: int | Conic = 4326, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Features of GeoJSON collections as id, name, borough and polygons in longitude/latitude.

    Property names vary between publications; the first alias present in a feature is taken. Files
    below ``path`` are shared out in ranges of ``block_bytes``; in stores that only Spark reads, a
    file is one task.
    """
    read = _split_features(spark, path, block_bytes) if arrow_knows(path) else _whole_features(spark, path)
    features = read.select(_lower_keys(F.col("f.properties")).alias("p"), F.col("f.geometry").alias("g"))
    named = [_first_alias(F.col("p"), target).alias(target) for target in S.NEIGHBORHOOD_ALIASES]
    return features.select(*named, to_wgs84(parse_geometry(F.col("g")), epsg).alias("geometry"))


def _whole_features(spark: SparkSession, path: str) -> DataFrame:
    """Features as column ``f``, each file by one task."""
    collection = T.StructType([T.StructField("features", T.ArrayType(_FEATURE))])
    return spark.read.schema(collection).option("multiLine", True).json(path).select(F.explode("features").alias("f"))


def _split_features(spark: SparkSession, path: str, block_bytes: int) -> DataFrame:
    """Features as column ``f``, each range of a file by one task.

    Other members of a document may hold objects as deep as features, such as the properties of its
    coordinate system. What calls itself a feature counts, and without a type what has the parts of one.
    """
    typed = T.StructType([T.StructField("type", T.StringType()), *_FEATURE.fields])
    objects = nested_objects(spark, path, _OPEN_BEFORE, block_bytes)
    parsed = objects.select(F.from_json("value", typed).alias("f"))
    parts = F.col("f.properties").isNotNull() | F.col("f.geometry").isNotNull()
    return parsed.where((F.col("f.type") == "Feature") | (F.col("f.type").isNull() & parts))


def parse_geometry(geometry: Column) -> Column:
    """Polygon and MultiPolygon alike as an array of polygons; NULL for other geometry types."""
    text = geometry["coordinates"]
    single = F.from_json(text, S.POLYGON)
    return (
        F.when(geometry["type"] == "Polygon", F.array(single))
        .when(geometry["type"] == "MultiPolygon", F.from_json(text, S.GEOMETRY))
    )


def geometry_json(geometry: Column) -> Column:
    """Geometry as a GeoJSON MultiPolygon string."""
    return F.to_json(F.struct(
        F.lit("MultiPolygon").alias("type"), geometry.alias("coordinates"),
    ))


def canonical_neighborhoods(df: DataFrame) -> DataFrame:
    """Rename alias columns of a polygon table to the canonical names, case-insensitively."""
    present = {name.lower(): name for name in df.columns}
    chosen = []
    for target, aliases in S.NEIGHBORHOOD_ALIASES.items():
        source = next((present[a] for a in aliases if a in present), None)
        if source is None:
            raise ValueError(f"no column for {target}; expected one of {aliases}")
        chosen.append(F.col(f"`{source}`").cast("string").alias(target))
    return df.select(*chosen, "geometry")


def _lower_keys(properties: Column) -> Column:
    return F.transform_keys(properties, lambda k, v: F.lower(k))


def _first_alias(properties: Column, target: str) -> Column:
    values = [F.try_element_at(properties, F.lit(a)) for a in S.NEIGHBORHOOD_ALIASES[target]]
    return F.coalesce(*values)
