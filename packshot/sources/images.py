"""Images as raster tables and as Spark image structs.

A raster table has one row per pixel, ``(image_id, x, y, r, g, b, a)``. Stored pictures use the
columns of Spark's image source: ``height, width, nChannels, mode, data``, bytes in B, G, R(, A)
order.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packshot.functions.paths import base_name
from packshot.operators import blocks

# OpenCV type codes that Spark's image source uses.
MODE_BGR = 16
MODE_BGRA = 24

IMAGE_SCHEMA = "image_id string, height int, width int, nChannels int, data binary"
RASTER_SCHEMA = "image_id string, x int, y int, r int, g int, b int, a int"


def list_images(spark: SparkSession, path: str) -> DataFrame:
    """``(image_id, path)`` of the files there are, the file name as id; no content is read.

    File names have to differ between folders: two pictures under one id would mix, so that raises.
    """
    files = spark.read.format("binaryFile").load(path).select(base_name("path").alias("image_id"), "path")
    twice = files.groupBy("image_id").count().where("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"several images have one file name: {', '.join(r['image_id'] for r in twice)}")
    return files


def read_images(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """``(image_id, height, width, nChannels, data)`` with the file name as id; unreadable files are left out.

    With ``wanted`` (a column ``image_id``) the files are listed first, and only those that it names are
    opened and decoded. Their paths pass the driver, as those of every file of a scan do.
    """
    files = list_images(spark, path)
    reader = spark.read.format("image").option("dropInvalid", True)
    if wanted is None:
        images = reader.load(path)
    else:
        chosen = files.join(wanted.select("image_id").distinct(), "image_id", "left_semi").select("path")
        paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", r["path"]) for r in chosen.toLocalIterator()]
        if not paths:
            return spark.createDataFrame([], IMAGE_SCHEMA)
        images = reader.load(paths)
    # the origin is a URI, in which a plus sign is one
    origin = F.url_decode(F.replace("image.origin", F.lit("+"), F.lit("%2B")))
    return images.select(base_name(origin).alias("image_id"), "image.height", "image.width", "image.nChannels", "image.data")


def to_raster(images: DataFrame) -> DataFrame:
    """Pixel rows of stored images (1, 3 or 4 channels)."""

    def unpack(batches):
        import numpy as np
        import pyarrow as pa

        rows_per_batch = 1 << 18
        for batch in batches:
            for image_id, h, w, n, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
                pixels = np.frombuffer(data, np.uint8).reshape(h * w, n)
                for start in range(0, h * w, rows_per_batch):
                    part = pixels[start : start + rows_per_batch].astype(np.int32)
                    place = np.arange(start, start + len(part))
                    blue, green, red = (part[:, 0],) * 3 if n == 1 else (part[:, 0], part[:, 1], part[:, 2])
                    alpha = part[:, 3] if n == 4 else np.full(len(part), 255, np.int32)
                    columns = [place % w, place // w, red, green, blue, alpha]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([image_id] * len(part)), *(pa.array(c.astype(np.int32)) for c in columns)],
                        names=["image_id", "x", "y", "r", "g", "b", "a"],
                    )

    source = images.select(F.col("image_id").cast("string"), "height", "width", "nChannels", "data")
    return source.mapInArrow(unpack, RASTER_SCHEMA)


def picture_structs(pictures: DataFrame, keys: list[str], alpha: bool) -> DataFrame:
    """Pictures of side ``size`` from blocks ``(keys..., size, tx, ty, cells)``, one row per ``keys`` and size.

    What is not drawn is white (transparent white with ``alpha``).
    """
    channels = 4 if alpha else 3
    return blocks.assemble(pictures, keys, channels).select(
        *keys,
        "size",
        F.col("size").alias("height"),
        F.col("size").alias("width"),
        F.lit(channels).alias("nChannels"),
        F.lit(MODE_BGRA if alpha else MODE_BGR).alias("mode"),
        "data",
    )


def to_image_structs(raster: DataFrame, keys: list[str], size: str, alpha: bool) -> DataFrame:
    """``picture_structs`` from the drawn pixels of a raster table, whose column ``size`` names the side.

    Of several pixels at one place the one with the least colour value counts.
    """
    raster = raster.withColumnRenamed(size, "size") if size != "size" else raster
    if not alpha:
        raster = raster.withColumn("a", F.lit(255))
    found = picture_structs(blocks.pack(raster, [*keys, "size"]), keys, alpha)
    return found.withColumnRenamed("size", size) if size != "size" else found


def write_images(images: DataFrame, folder: str, day: str, kind: str) -> None:
    """Store image structs below ``folder`` by day, kind and size; a repeated run replaces its own.

    Column ``path``, if there is one, is the name of the picture in the manifest.
    """
    dated = images.withColumn("day", F.lit(day)).withColumn("kind", F.lit(kind))
    writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day", "kind", "size").parquet(folder)
