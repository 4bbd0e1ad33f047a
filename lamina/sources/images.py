"""Image folders as relations: names, content hashes and sizes from headers, without decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Suffixes of images.
SUFFIXES = ["png", "jpg", "jpeg", "webp", "bmp", "tif", "tiff"]


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """(path, file_name, length, content, sha256) of a folder's own images, not of its subfolders', in path order."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder)
    return select_images(found).withColumn("sha256", F.sha2("content", 256)).orderBy("path")


def select_images(files: DataFrame) -> DataFrame:
    """Files (path, length, content) whose name is an image's; names with a colon are leftovers of other systems."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select("path", name.alias("file_name"), "length", "content").where(~F.contains(F.col("file_name"), F.lit(":")) & F.lower(F.regexp_extract("file_name", r"\.([^.]+)$", 1)).isin(*SUFFIXES))


def _number(content: Column, at, size: int, little=False) -> Column:
    """The unsigned number in ``size`` bytes from ``at`` (from 1); ``little`` may be a column."""
    at = at if isinstance(at, Column) else F.lit(at)
    digits = F.hex(F.substring(content, at, F.lit(size)))
    turned = F.concat(*[F.substring(digits, 2 * i + 1, 2) for i in reversed(range(size))])
    if isinstance(little, Column):
        return F.conv(F.when(little, turned).otherwise(digits), 16, 10).cast("long")
    return F.conv(turned if little else digits, 16, 10).cast("long")


#: Segments of a JPEG file and entries of a TIFF directory that are looked at.
SEGMENTS = 512


def _jpeg_size(content: Column) -> Column:
    """(width, height) of the first frame header; segments are skipped by their lengths."""
    start = F.struct(F.lit(3).cast("long").alias("at"), F.lit(False).alias("found"), F.lit(False).alias("over"))

    def step(s: Column, _: Column) -> Column:
        marker = F.hex(F.substring(content, s["at"].cast("int"), F.lit(2)))
        frame = marker.rlike("^FFC[0-35-79-BD-F]$")
        fill, alone = marker == "FFFF", marker.rlike("^FF(01|D[0-7])$")
        ends = ~F.coalesce(marker.rlike("^FF[^0]"), F.lit(False)) & ~alone | marker.isin("FFD9", "FFDA")
        onward = F.when(fill, s["at"] + 1).when(alone, s["at"] + 2).otherwise(s["at"] + 2 + F.coalesce(_number(content, (s["at"] + 2).cast("int"), 2), F.lit(0)))
        stay = s["found"] | s["over"] | frame | ends
        return F.struct(F.when(stay, s["at"]).otherwise(onward).cast("long").alias("at"), (s["found"] | (~s["over"] & frame)).alias("found"), (s["over"] | (~s["found"] & ~frame & ends)).alias("over"))

    at = F.aggregate(F.sequence(F.lit(1), F.lit(SEGMENTS)), start, step, lambda s: F.when(s["found"], s["at"]).cast("int"))
    return F.transform(F.array(at), lambda p: F.struct(_number(content, p + 7, 2).alias("width"), _number(content, p + 5, 2).alias("height")))[0]


def _webp_size(content: Column) -> Column:
    chunk, packed = F.hex(F.substring(content, 13, 4)), _number(content, 22, 4, True)
    width = F.when(chunk == "56503820", _number(content, 27, 2, True).bitwiseAND(0x3FFF)).when(chunk == "5650384C", packed.bitwiseAND(0x3FFF) + 1).when(chunk == "56503858", _number(content, 25, 3, True) + 1)
    height = F.when(chunk == "56503820", _number(content, 29, 2, True).bitwiseAND(0x3FFF)).when(chunk == "5650384C", F.shiftright(packed, 14).bitwiseAND(0x3FFF) + 1).when(chunk == "56503858", _number(content, 28, 3, True) + 1)
    return F.struct(width.alias("width"), height.alias("height"))


def _tiff_size(content: Column) -> Column:
    """(width, height) of the first directory: its entries of tag 256 and 257, short or long."""
    little = F.hex(F.substring(content, 1, 2)) == "4949"
    first = (_number(content, 5, 4, little) + 1).try_cast("int")
    entries = F.transform(F.sequence(F.lit(0), F.least(_number(content, first, 2, little), F.lit(SEGMENTS)).cast("int") - 1), lambda i: first + 2 + 12 * i)
    value = lambda tag: F.get(F.transform(F.filter(entries, lambda at: _number(content, at, 2, little) == tag), lambda at: F.when(_number(content, at + 2, 2, little) == 3, _number(content, at + 8, 2, little)).otherwise(_number(content, at + 8, 4, little))), 0)
    return F.struct(value(256).alias("width"), value(257).alias("height"))


def header(content: Column) -> Column:
    """(format, width, height) as the first bytes tell, whatever the suffix; null where they don't."""
    head = F.hex(F.substring(content, 1, 12))
    kind = (
        F.when(head.startswith("89504E470D0A1A0A"), "PNG").when(head.startswith("FFD8FF"), "JPEG").when(head.startswith("47494638"), "GIF").when(head.startswith("424D"), "BMP")
        .when(head.startswith("52494646") & head.endswith("57454250"), "WEBP").when(head.startswith("49492A00") | head.startswith("4D4D002A"), "TIFF")
    )
    plain = lambda w, h: F.struct(w.alias("width"), h.alias("height"))
    size = (
        F.when(kind == "PNG", plain(_number(content, 17, 4), _number(content, 21, 4)))
        .when(kind == "BMP", plain(_number(content, 19, 4, True), F.least(_number(content, 23, 4, True), (1 << 32) - _number(content, 23, 4, True))))
        .when(kind == "GIF", plain(_number(content, 7, 2, True), _number(content, 9, 2, True)))
        .when(kind == "JPEG", _jpeg_size(content)).when(kind == "WEBP", _webp_size(content)).when(kind == "TIFF", _tiff_size(content))
    )
    return F.transform(F.array(size), lambda s: F.struct(kind.alias("format"), s["width"].try_cast("int").alias("width"), s["height"].try_cast("int").alias("height")))[0]


def preview_size(width: Column, height: Column, most: int) -> Column:
    """Size whose longest side is at most ``most``."""
    scale = F.least(F.lit(1.0), F.lit(float(most)) / F.greatest(width, height))
    side = lambda x: F.greatest(F.lit(1), F.bround(x * scale)).cast("int")
    return F.struct(side(width).alias("width"), side(height).alias("height"))


def resolve(template: DataFrame | None, long: DataFrame, table: DataFrame) -> DataFrame:
    """(file_name, branch, ord): a template's order if there is one, else long images and then tables by name.

    Names whose bytes were read in the wrong encoding are matched to the template's; two files of one name are an error
    for the caller to find by counting.
    """
    from pyspark.sql import Window

    from lamina.functions.text import repair_name

    files = long.select("file_name", F.lit("long").alias("branch")).unionByName(table.select("file_name", F.lit("table").alias("branch")))
    if template is None:
        return files.withColumn("ord", F.row_number().over(Window.orderBy("branch", "file_name")) - 1)
    # Two equi-joins: a file of the official name goes before one whose repaired name is that.
    named = template.select("file_name", "ord")
    exact = files.join(named, "file_name").select("file_name", "branch", "ord")
    repaired = files.join(named.select("file_name"), "file_name", "left_anti").select(repair_name("file_name").alias("file_name"), "branch")
    return exact.unionByName(repaired.join(named, "file_name").select("file_name", "branch", "ord"))
