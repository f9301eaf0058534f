"""Path and file name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from packshot.functions.dates import format_day

# Markers of a path template, folder names and mapping file of the outputs.
DATE_MARK = "<DATE>"
ENV_MARK = "<ENV>"
LAYER_FOLDER = "layer_imgs"
BUNDLE_FOLDER = "package_imgs"
MAPPING_FILE = "package_to_image_mapping.csv"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def uri_bucket(uri: Column | str, scheme: str = "gs") -> Column:
    """Bucket of ``scheme://bucket/key``; NULL for anything else."""
    return F.nullif(F.regexp_extract(_col(uri), f"^{scheme}://([^/]+)/.*$", 1), F.lit(""))


def uri_key(uri: Column | str, scheme: str = "gs") -> Column:
    """Key of ``scheme://bucket/key`` (empty for a bare bucket); NULL for anything else."""
    uri = _col(uri)
    pattern = f"^{scheme}://[^/]+/(.*)$"
    return F.when(uri.rlike(pattern), F.regexp_extract(uri, pattern, 1))


def fill_path(template: Column | str, day: Column | None = None, env: Column | None = None, divider: str = "-") -> Column:
    """Replace the date and environment markers of a path template; a marker without value stays."""
    path = _col(template)
    if day is not None:
        path = F.replace(path, F.lit(DATE_MARK), format_day(day, divider))
    if env is not None:
        path = F.replace(path, F.lit(ENV_MARK), env)
    return path


def base_name(path: Column | str) -> Column:
    """What follows the last slash."""
    return F.substring_index(_col(path), "/", -1)


def has_extension(name: Column | str) -> Column:
    """Whether a file name has an extension; leading dots belong to the stem."""
    return _col(name).rlike(r"^\.*[^.].*\.[^.]*$")


def stem(name: Column | str) -> Column:
    """The file name without its extension."""
    name = _col(name)
    return F.when(has_extension(name), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name)


def extension(name: Column | str) -> Column:
    """The extension with its dot, or empty text."""
    name = _col(name)
    return F.when(has_extension(name), F.regexp_extract(name, r"\.[^.]*$", 0)).otherwise(F.lit(""))


def image_file(image: Column | str) -> Column:
    """File name of an image reference; ``.jpg`` unless it names another kind."""
    name = base_name(image)
    return F.when(has_extension(name), name).otherwise(F.concat(name, F.lit(".jpg")))


def image_path(image: Column | str) -> Column:
    """Sharded path of an image: the first two characters of its file name, slash, file name."""
    name = image_file(image)
    return F.concat(F.substring(name, 1, 2), F.lit("/"), name)


def sized_name(name: Column | str, size: Column | str) -> Column:
    """``stem_size.ext``"""
    return F.concat(stem(name), F.lit("_"), _col(size).cast("string"), extension(name))
