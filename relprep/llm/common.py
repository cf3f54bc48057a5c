"""Helpers shared by the corpus operators of this subpackage.

Row identity: the operators address a document by ``doc_id`` and, where
``doc_id`` may repeat, by the pair (``doc_id``, hash of the text), so rows
that are equal in both get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relprep.session import scratch_path
from relprep.sources.files import remove
from relprep.sources.sinks import materialize

#: White space between words: space and tab to carriage return (fixed by the contracts).
SPACE = "\\x20\\x09-\\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read again.

    The files outlive any executor, so later reads never recompute what
    produced them.
    """
    return materialize(df, scratch_path(df.sparkSession, name))


class Passing:
    """Tables written as ``written`` does, denser, that are removed once nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def written(self, df: DataFrame, name: str) -> DataFrame:
        self.paths[name] = scratch_path(self.spark, name)
        df.write.mode("errorifexists").option("compression", "zstd").parquet(self.paths[name])
        return self.spark.read.schema(df.schema).parquet(self.paths[name])

    def remove(self, *names: str) -> None:
        for name in names if hasattr(self.spark, "_jvm") else ():  # Spark Connect clients: the server's owner clears the folder
            remove(self.spark, self.paths.pop(name))


def words(text: Column) -> Column:
    """The words of a text (null: none) as an array, with JVM functions only."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+", -1))


def unused(columns: list[str], *names: str) -> list[str]:
    """``names``, each with as many underscores in front as it takes to clash with no column."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def matching(docs: DataFrame, keys: DataFrame, how: str, host: str | None = None) -> DataFrame:
    """``docs`` joined (left_semi, left_anti) with the documents that ``keys`` names.

    ``keys`` has doc_id, text_hash and, where ``host`` names a column of ``docs``, host.
    """
    names = unused(docs.columns, "doc", "hash", *(["of"] if host else []))
    own = ["doc_id", "text_hash", *(["host"] if host else [])]
    keys = keys.select(*[F.col(c).alias(n) for c, n in zip(own, names)]).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(names[0])) & F.xxhash64("text").eqNullSafe(F.col(names[1]))
    if host:
        same = same & F.col(host).eqNullSafe(F.col(names[2]))
    return docs.join(keys, same, how)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def connected_components(edges: DataFrame, name: str = "cc", max_rounds: int = 40) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it reaches.

    Alternates the large-star and small-star steps of Kiveris et al.: each
    step only groups a node's neighbours and joins the minimum back, so a
    component of any size is spread over many tasks, and the number of
    rounds grows with the logarithm of a component's length.  Every round
    is a written table; the driver sees two numbers a round.  Self loops and
    repeated edges are allowed; null ends are dropped.
    """
    e = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    e = written(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0")
    seen = None
    for i in range(1, max_rounds + 1):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        e = written(small.where("u <> v").distinct(), f"{name}-{i}")
        mark = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
