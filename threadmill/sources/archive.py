"""Archives kept as id-keyed JSON maps: ``<folder>/posts.json`` and ``comments.json``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..schemas import COMMENT, POST
from ..session import materialize

# Fixed value: how a record ends in a map written with an indent of two. Text inside JSON
# strings never holds a line break, and deeper objects close with a deeper indent, so the
# sequence is found at record ends and nowhere else.
RECORD_END = "\n  },\n"


def _map_entries(df: DataFrame, text: Column) -> DataFrame:
    keyed = df.withColumn("_map", F.from_json(text, "map<string,variant>"))
    others = [c for c in df.columns]
    return keyed.select(*others, F.explode("_map").alias("key", "record"))


def records_of_map_text(df: DataFrame, text: str) -> DataFrame:
    """``key, record`` of every object in the id-keyed maps of a text column."""
    rows = _map_entries(df, F.col(text))
    return rows.filter(F.startswith(F.schema_of_variant("record"), F.lit("OBJECT"))).drop(text)


def discover(spark: SparkSession, root: str) -> DataFrame:
    """``folder, name, length`` of the map files under ``root``.

    If ``root`` itself holds one, only ``root`` counts; else folders at any depth do. Reads
    file listings only.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "{posts,comments}.json")
        .load(root)
        .select(_folder_of(F.col("path")).alias("folder"), _name_of(F.col("path")).alias("name"), "length")
    )
    here = files.filter(_same_folder(F.col("folder"), root))
    return here if here.limit(1).count() else files


def root_holds_maps(spark: SparkSession, root: str) -> bool:
    """Whether ``root`` itself holds a map file, so that its folders do not count."""
    return not discover(spark, root).filter(_same_folder(F.col("folder"), root)).isEmpty()


def relative_folder(folder: Column, root: str) -> Column:
    """A folder's path below ``root``; ``.`` for ``root`` itself. Base names may repeat."""
    bare = F.regexp_replace(F.regexp_replace(folder, r"^[a-z0-9]+:/*", "/"), "/+$", "")
    top = F.regexp_replace(F.regexp_replace(F.lit(root), r"^[a-z0-9]+:/*", "/"), "/+$", "")
    below = F.ltrim(F.substr(bare, F.length(top) + 2))
    return F.when(F.startswith(bare, F.concat(top, F.lit("/"))), below).when(bare == top, ".").otherwise(bare)


def _folder_of(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def _name_of(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)$", 1)


def _same_folder(folder: Column, root: str) -> Column:
    def bare(c: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(c, r"^[a-z0-9]+:/*", "/"), "/+$", "")

    return bare(folder) == bare(F.lit(root))


def _pieces(
    spark: SparkSession, root: str, name: str, one_level: bool = False, nested: bool = True
) -> DataFrame:
    """The files cut at record ends, each piece completed to a small map of its own.

    The text reader splits files at any record end, so one huge map is read by many tasks.
    """
    text = (
        spark.read.option("lineSep", RECORD_END)
        .option("recursiveFileLookup", str(nested).lower())
        .option("pathGlobFilter", name)
        .text(root)
        .select(_folder_of(F.col("_metadata.file_path")).alias("folder"), "value")
    )
    if one_level:
        text = text.filter(_same_folder(_folder_of(F.col("folder")), root))
    opens = F.startswith(F.ltrim("value"), F.lit("{"))
    closes = F.rlike("value", F.lit(r"(^|\n)\}\s*$")) | (opens & ~F.contains("value", F.lit("\n")))
    return text.select(
        "folder",
        closes.alias("_closes"),
        opens.alias("_opens"),
        F.concat(
            F.when(opens, F.lit("")).otherwise(F.lit("{")),
            F.col("value"),
            F.when(closes, F.lit("")).otherwise(F.lit("}}")),
        ).alias("_map_text"),
    )


def _running(rows: DataFrame, value: str, out: str, by: list[str]) -> DataFrame:
    """Sum of ``value`` over the rows of a file up to each one, in file order.

    Rows are added up within their block, blocks among themselves (a row for each), so that the
    blocks of one file are worked on by many tasks.
    """
    totals = rows.groupBy("file", "block").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("file", "block", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    here = F.sum(value).over(Window.partitionBy("file", "block").orderBy(*by))
    return rows.join(totals, ["file", "block"]).withColumn(out, here + F.col("_before")).drop("_before")


def _any_layout(
    spark: SparkSession, root: str, name: str, one_level: bool, nested: bool, folders: DataFrame
) -> "MapScan":
    """The files called ``name`` of ``folders``, whatever their layout.

    The text reader cuts files at every closing brace, so that blocks of one file go to many
    tasks. Running counts of quotes tell which cuts lie inside a string, running counts of
    brackets how deep the others are; a cut one level deep is the end of a record. What lies
    between two such ends is completed to a small map of its own.
    """
    text = (
        spark.read.option("lineSep", "}")
        .option("recursiveFileLookup", str(nested).lower())
        .option("pathGlobFilter", name)
        .text(root)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"),
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), "value",
        )
        .withColumn("folder", _folder_of(F.col("file")))
    )
    if one_level:
        text = text.filter(_same_folder(_folder_of(F.col("folder")), root))
    rows = materialize(text.join(folders, "folder", "left_semi"), "parts")
    # A brace after a backslash can only be wrong JSON, so no escape goes from one row into the next.
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    rows = rows.withColumn("quotes", F.length(plain) - F.length(F.replace(plain, F.lit('"'))))
    rows = materialize(_running(rows, "quotes", "quoted", ["row"]), "quoted")
    inside_at_end = F.col("quoted") % 2 == 1
    inside_at_start = (F.col("quoted") - F.col("quotes")) % 2 == 1
    # Complete strings go, so what is left lies outside of all of them.
    bare = F.concat(F.when(inside_at_start, F.lit('"')).otherwise(F.lit("")), "value", F.when(inside_at_end, F.lit('"')).otherwise(F.lit("")))
    bare = F.regexp_replace(bare, r'(?s)"(?:[^"\\]++|\\.)*+"', "")
    sizes = rows.groupBy("file").agg(
        F.sum(F.octet_length("value") + 1).alias("read"), F.max("bytes").alias("bytes"),
        F.max(F.struct("block", "row")).alias("end"),
    )
    # Every row but the last of a file has lost a brace; the last one too if all bytes are there.
    rows = rows.join(sizes.select("file", "end", (F.col("read") == F.col("bytes")).alias("full")), "file")
    braced = F.col("full") | (F.struct("block", "row") < F.col("end"))
    rows = rows.withColumns({"braced": braced, "closes": braced & ~inside_at_end, "bare": bare})
    opened = F.length("bare") - F.length(F.regexp_replace("bare", r"[\[{]", ""))
    closed = F.length("bare") - F.length(F.replace("bare", F.lit("]"))) + F.col("closes").cast("int")
    rows = _running(rows.withColumn("step", opened - closed).drop("bare"), "step", "depth", ["row"])
    rows = materialize(rows.withColumn("ends", (F.col("closes") & (F.col("depth") == 1)).cast("int")), "depths")
    rows = _running(rows, "ends", "ended", ["row"]).withColumn("record", F.col("ended") - F.col("ends"))
    part = F.concat("value", F.when(F.col("braced"), F.lit("}")).otherwise(F.lit("")))
    pieces = rows.groupBy("file", "folder", "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "row", part.alias("part")))), lambda p: p["part"]), "").alias("text"),
        F.max("ends").alias("ends"), F.max(F.struct("block", "row", "depth", inside_at_end.alias("open"))).alias("last"),
        F.count_if(F.col("depth") < 0).alias("below"), F.max("end").alias("end"),
    )
    at_end = F.struct("last.block", "last.row") == F.col("end")
    first = F.col("record") == 0
    begins = F.rlike("text", F.when(first, F.lit(r"^\s*\{")).otherwise(F.lit(r"^\s*,")))
    # Behind the last record there may be members that are no records, and the end of the map.
    rest = (F.col("ends") == 0) & ~first
    body = F.when(begins, F.regexp_replace("text", r"^\s*[{,]", "")).otherwise(F.when(rest, F.col("text")))
    made = F.concat(F.lit("{"), body, F.when(F.col("ends") == 1, F.lit("}")).otherwise(F.lit("")))
    # The file must end at depth 0, outside strings, and hold nothing behind its map.
    over = ~at_end | ((F.col("last.depth") == 0) & ~F.col("last.open") & F.rlike("text", F.lit(r"\}\s*$")))
    over &= ~F.rlike("text", F.lit(r"^\s*,\s*\}"))  # a comma with nothing behind it
    pieces = materialize(
        pieces.select("folder", made.alias("_map_text"), (over & (F.col("below") == 0) & (F.col("ends") + at_end.cast("int") > 0)).alias("_right"), at_end.alias("_closes"), first.alias("_opens")),
        "maps",
    )
    return _scan(pieces)


def _scan(pieces: DataFrame) -> "MapScan":
    """Entries of the pieces of sound files: every piece an object, one of them the begin, one the end."""
    # As the one item of a list, since the reader overlooks what stands behind a value.
    items = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), "_map_text", F.lit("]"))), "$", "array<variant>")
    sound = (F.size(items) == 1) & F.startswith(F.ltrim("_map_text"), F.lit("{")) & F.col("_right")
    broken = (
        pieces.groupBy("folder")
        .agg(
            F.count_if(~F.coalesce(sound, F.lit(False))).alias("bad"),
            F.count_if("_opens").alias("begins"), F.count_if("_closes").alias("ends"),
        )
        .filter((F.col("bad") > 0) | (F.col("begins") != 1) | (F.col("ends") != 1))
        .select("folder")
    )
    good = pieces.join(broken, "folder", "left_anti").select("folder", "_map_text")
    return MapScan(records_of_map_text(good, "_map_text"), broken)


@dataclass
class MapScan:
    """Entries of a map file per folder, and the folders whose file is not a sound map."""

    records: DataFrame
    broken: DataFrame


def scan_maps(
    spark: SparkSession, root: str, name: str, one_level: bool = False, nested: bool = True
) -> MapScan:
    """Scan all files called ``name`` under ``root``, only those of its direct folders, or
    (not ``nested``) only the one in ``root`` itself.

    Maps that are indented by two, as they are usually written, are cut at their record ends by
    the text reader alone. Files that do not read well that way are read once more by their
    brackets, in any layout. Broken files are those that are no sound map then either; none of
    their records is returned.
    """
    pieces = _pieces(spark, root, name, one_level, nested).withColumn("_right", F.lit(True))
    usual = _scan(pieces)
    other = materialize(usual.broken, "unusual", small=True)
    if other.isEmpty():
        return MapScan(usual.records, other)
    found = _any_layout(spark, root, name, one_level, nested, other)
    good = pieces.join(other, "folder", "left_anti").select("folder", "_map_text")
    return MapScan(records_of_map_text(good, "_map_text").unionByName(found.records), found.broken)


def _stored(records: DataFrame, schema, keep: list[str]) -> DataFrame:
    record = F.col("record")

    def column(field) -> Column:
        kind = field.dataType.simpleString()
        if field.name == "raw":
            raw = F.try_variant_get(record, "$.raw", "variant")
            return F.when(raw.isNotNull() & ~F.is_variant_null(raw), F.to_json(raw))
        if kind == "timestamp":
            return F.try_variant_get(record, f"$.{field.name}", "string").try_cast("timestamp")
        return F.try_variant_get(record, f"$.{field.name}", kind)

    return records.select(*keep, *[column(f).alias(f.name) for f in schema.fields])


def stored_posts(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Stored post records (VARIANT column ``record``) as typed rows."""
    return _stored(records, POST, keep or [])


def stored_comments(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return _stored(records, COMMENT, keep or [])


@dataclass
class Archive:
    posts: DataFrame
    comments: DataFrame
    failed: DataFrame


def read_archive(
    spark: SparkSession, root: str, whole_folders: bool = False, one_level: bool = False,
    nested: bool = True,
) -> Archive:
    """Posts and comments of all folders (or the direct ones), each row with its ``folder``.

    A broken file counts as empty. With ``whole_folders`` it takes its folder out of both
    tables, as a merge does; ``failed`` lists such folders either way. Spark never opens a
    file of length zero, so such a file counts as missing.
    """
    posts = scan_maps(spark, root, "posts.json", one_level, nested)
    comments = scan_maps(spark, root, "comments.json", one_level, nested)
    failed = posts.broken.unionByName(comments.broken).distinct()
    post_rows = stored_posts(posts.records, ["folder"])
    comment_rows = stored_comments(comments.records, ["folder"])
    if whole_folders:
        post_rows = post_rows.join(failed, "folder", "left_anti")
        comment_rows = comment_rows.join(failed, "folder", "left_anti")
    return Archive(post_rows, comment_rows, failed)
