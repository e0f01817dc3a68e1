"""File sources: delimited text with and without header, preamble lines, vectors, JSON feeds, HTML rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True) -> DataFrame:
    """CSV scan. Without a schema Spark infers one, which reads the data twice."""
    reader = spark.read.option("header", header).option("multiLine", False)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_delimited(spark: SparkSession, path: str, names: str, sep: str = "\t") -> DataFrame:
    """Delimited scan of a file without header; ``names`` is the schema text."""
    return spark.read.option("sep", sep).schema(names).csv(path)


def escaped(text: Column) -> Column:
    """Text for one field of a line: backslash, tab and line ends are written as two characters."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for sign, name in (("\t", "t"), ("\n", "n"), ("\r", "r")):
        out = F.replace(out, F.lit(sign), F.lit("\\" + name))
    return out


def _signs(part: Column) -> Column:
    for sign, name in (("\t", "t"), ("\n", "n"), ("\r", "r")):
        part = F.replace(part, F.lit("\\" + name), F.lit(sign))
    return part


def unescaped(text: Column) -> Column:
    """The reverse of ``escaped``."""
    parts = F.split(text, r"\\\\", -1)  # two backslashes are one; what is left names tabs and line ends
    parts = F.transform(parts, _signs)
    return F.array_join(parts, "\\")


def read_with_preamble(spark: SparkSession, path: str, schema: str, sep: str = "\t", comment: str = "#",
                       skip: str = r"^\d+[a-z](\t\d+[a-z])*$") -> DataFrame:
    """Delimited scan that drops comment lines, the header line and format lines matching ``skip``."""
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    lines = (spark.read.text(path)
             .filter(~F.col("value").startswith(comment))
             .filter(~F.col("value").rlike(skip))
             .filter(F.col("value") != sep.join(names)))
    return lines.select(F.from_csv("value", F.lit(schema), {"sep": sep}).alias("r")).select("r.*")


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a word and its numbers, separated by spaces."""
    parts = spark.read.text(path).select(F.split("value", " ").alias("p"))
    return parts.select(
        F.get("p", F.lit(0)).alias("word"),
        F.transform(F.slice("p", F.lit(2), F.size("p") - 1), lambda x: x.cast("float")).alias("vector"))


def read_feed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with nested records, typed by ``schema``."""
    return spark.read.schema(schema).json(path)


def flatten_games(feed: DataFrame) -> DataFrame:
    """One row per game of each day; primitive keys kept, the two team objects lifted."""
    games = feed.select("day", F.explode("games").alias("g"))
    return games.select(
        "day", "g.game_id", "g.text",
        F.col("g.home.id").alias("home_id"), F.col("g.home.score").alias("home_score"),
        F.col("g.away.id").alias("away_id"), F.col("g.away.score").alias("away_score"))


def read_open_feed(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as one variant column ``v``, whatever keys they hold; broken lines fail."""
    return spark.read.option("singleVariantColumn", "v").json(path)


def _plain(value: Column) -> Column:
    """The variant where it is a number, text or truth value, else null."""
    kind = F.schema_of_variant(value)
    return F.when(~kind.startswith("OBJECT") & ~kind.startswith("ARRAY") & (kind != "VOID"), value)


def _stored(kind: str) -> str:
    """Column type of a key whose values have this common variant type."""
    if kind.startswith("DECIMAL"):
        digits, scale = map(int, kind[8:-1].split(","))
        return f"decimal({digits},0)" if scale == 0 and digits > 18 else "double"
    return {"BIGINT": "bigint", "DOUBLE": "double", "FLOAT": "double", "BOOLEAN": "boolean"}.get(kind, "string")


def feed_keys(records: DataFrame, col: str) -> list[tuple[list[str], str]]:
    """Names and column type of each key that holds a primitive value anywhere, in the order of names.

    One pass with partial sums; what comes to the driver is one row per key, as in schema inference. Names that
    differ in letter case only come together. Values of several types become text.
    """
    each = records.select(F.explode(F.map_entries(F.try_variant_get(col, "$", "map<string,variant>"))).alias("e"))
    held = each.select("e.key", _plain(F.col("e.value")).alias("value")).filter("value IS NOT NULL")
    found = held.groupBy(F.lower("key").alias("k")).agg(
        F.sort_array(F.collect_set("key")).alias("names"), F.schema_of_variant_agg("value").alias("kind"))
    return [(list(r.names), _stored(r.kind)) for r in sorted(found.collect(), key=lambda r: r.k)]


def flatten_feed(feed: DataFrame, records: str, outer: dict[str, str], lifted: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per record of a feed of unknown keys, as read by ``read_open_feed``.

    ``records`` is the path of the list in a line. ``outer`` names keys of the line and their types, ``lifted`` gives
    columns by (path in the record, type). All keys of a record that hold a primitive value in any record are
    kept, so a key that a feed adds is a new column; lists, objects and nulls among their values are null. Where names
    differ in letter case only the first one that holds a value counts; a lifted or outer column hides a key of its
    name. A line without the list gives no row, a record that is no object only nulls. The feed is read
    once for its keys and once for its rows.
    """
    games = feed.select(*[F.try_variant_get("v", "$." + key, kind).alias(key) for key, kind in outer.items()],
                        F.explode(F.try_variant_get("v", records, "array<variant>")).alias("_g"))
    taken = {name.lower() for name in [*outer, *lifted]}
    keys = [(names, kind) for names, kind in feed_keys(games, "_g") if names[0].lower() not in taken]
    games = games.withColumn("_m", F.try_variant_get("_g", "$", "map<string,variant>"))

    def value(names: list[str], kind: str) -> Column:
        held = F.coalesce(*[_plain(F.try_element_at("_m", F.lit(n))) for n in names])
        return F.try_variant_get(held, "$", kind).alias(names[0])

    return games.select(*outer, *[value(*k) for k in keys],
                        *[F.try_variant_get("_g", path, kind).alias(out) for out, (path, kind) in lifted.items()])


def html_rows(df: DataFrame, html: str, pattern: str, out: str) -> DataFrame:
    """One row per match of the first group of ``pattern`` in the page."""
    found: Column = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    return df.withColumn(out, F.explode(found)).drop(html)
