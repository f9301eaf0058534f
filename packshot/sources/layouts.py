"""Layout and image settings (JSON configuration)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYOUT_SCHEMA = (
    "array<struct<bundle_type:string,"
    "bundle_layers:array<struct<productType:string,ulx:double,uly:double,w:double>>>>"
)

SETTINGS_SCHEMA = (
    "image_sizes array<int>, bundle_image_filetype string, erode_size int, bottom_border int, "
    "silo_filter_size_cutoff double, silo_white_min_cutoff double, "
    "silo_gray_max_cutoff double, silo_min_img_not_background double, canvas_side int"
)

SETTINGS_REQUIRED = ("bundle_image_filetype", "erode_size", "bottom_border")


def read_layouts(spark: SparkSession, path: str) -> DataFrame:
    """``(file, layout_idx, bundle_type, bundle_layers)`` of layout files, numbered in file order."""
    text = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    return parse_layouts(text)


def parse_layouts(text: DataFrame) -> DataFrame:
    """Layouts of the JSON lists in column ``value``; ``layout_idx`` is the place in its list.

    ``file`` names the list, if there are several; without the column it is empty.
    """
    file = F.col("file") if "file" in text.columns else F.lit("")
    return text.select(file.alias("file"), F.posexplode(F.from_json("value", LAYOUT_SCHEMA)).alias("layout_idx", "layout")).select(
        "file",
        "layout_idx",
        F.col("layout.bundle_type").alias("bundle_type"),
        F.col("layout.bundle_layers").alias("bundle_layers"),
    )


@dataclass(frozen=True)
class ImageSettings:
    """How pictures are cut out and drawn. The defaults of the ``silo`` settings are the usual ones.

    Pictures are stored at every size of ``image_sizes``; without any, once and unscaled, on a canvas of
    ``canvas_side``.
    """

    image_sizes: tuple[int, ...] | None
    bundle_image_filetype: str
    erode_size: int
    bottom_border: int
    silo_filter_size_cutoff: float = 0.002
    silo_white_min_cutoff: float = 1.0
    silo_gray_max_cutoff: float = 0.95
    silo_min_img_not_background: float = 0.1
    canvas_side: int | None = None

    def __post_init__(self) -> None:
        if not self.image_sizes and not self.canvas_side:
            raise ValueError("image settings need image_sizes or canvas_side")
        if self.image_sizes and self.canvas_side and self.canvas_side < max(self.image_sizes):
            raise ValueError("a canvas smaller than the largest picture")

    @property
    def canvas(self) -> int:
        """Side of the square a bundle picture is drawn on: the largest size, unless it is named."""
        return self.canvas_side or max(self.image_sizes)

    @property
    def sizes(self) -> tuple[int, ...]:
        """The sides of the stored pictures."""
        return self.image_sizes or (self.canvas,)


def image_settings(settings: DataFrame) -> DataFrame:
    """Settings rows with the canvas side added."""
    return settings.withColumn("canvas", F.array_max("image_sizes"))


def read_image_settings(spark: SparkSession, path: str) -> ImageSettings:
    """Settings of one JSON object; missing ``silo_*`` keys take their defaults, missing sizes mean unscaled pictures."""
    row = spark.read.schema(SETTINGS_SCHEMA).option("multiLine", True).json(path).first()
    missing = [k for k in SETTINGS_REQUIRED if row[k] is None]
    if missing:
        raise ValueError(f"image settings without {', '.join(missing)}")
    given = {k: v for k, v in row.asDict().items() if v is not None}
    given["image_sizes"] = tuple(given.get("image_sizes") or ()) or None
    return ImageSettings(**given)
