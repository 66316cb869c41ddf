"""Helpers that several corpus operators share: words, folds, staged tables, hot-group blocks, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from charloom.session import stage

WORD = "[^\\x20\\x09-\\x0D]+"
#: Rows of one side of a block pair; a hot group is met block by block.
BLOCK_ROWS = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def discard(staged: DataFrame) -> None:
    """Delete the folder of a staged table that nothing reads any more."""
    jvm, conf = staged.sparkSession.sparkContext._jvm, staged.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in staged.inputFiles()}:
        if folder.rpartition("/")[2].startswith("charloom-"):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def word_count(text: Column) -> Column:
    """Number of words split at ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(key: Column, n: int) -> Column:
    """``crc32`` of the key as text modulo ``n``; a NULL key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def lower_words(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8 with A-Z lower-cased; both methods of ``bytes`` know ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shield(df: DataFrame, inner: set[str], added: set[str]) -> tuple[DataFrame, dict[str, str]]:
    """Make room for the columns of an operator in a table that passes through it.

    Input columns named like one that the operator adds are dropped, as its own replaces them; those named like one
    that it uses inside are renamed, and the returned names bring them back (``unshield``).
    """
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in added])
    moved = {f"__in{i}": c for i, c in enumerate(df.columns) if c.lower() in inner}
    return df.withColumnsRenamed({c: n for n, c in moved.items()}), moved


def unshield(df: DataFrame, moved: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(moved) if moved else df


def block_pairs(
    df: DataFrame, group: list[str], key: str, block_rows: int = BLOCK_ROWS, weight: str | None = None
) -> DataFrame:
    """Deal the rows of each group into pairs of blocks, so that no task meets a whole hot group.

    A block has about ``block_rows`` rows, or rows of so much ``weight`` together.

    Adds ``_a`` and ``_b`` (``_a <= _b``), the pair of blocks, and ``_mine``, the block of the row. A group
    with ``c`` blocks becomes ``c * (c + 1) / 2`` pairs; every two of its rows meet in exactly one pair if
    they are in different blocks, and in the pair ``(a, a)`` if they share block ``a``.
    """
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    sizes = df.groupBy(*group).agg(F.ceil(total / F.lit(block_rows)).cast("int").alias("_blocks"))
    mine = F.pmod(F.xxhash64(F.col(key), F.lit("block")), F.col("_blocks")).cast("int")
    placed = df.join(sizes, group).withColumn("_mine", mine)
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return (
        placed.withColumn("_other", other)
        .withColumn("_a", F.least("_mine", "_other"))
        .withColumn("_b", F.greatest("_mine", "_other"))
        .drop("_blocks", "_other")
    )


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Connected components of undirected edges: ``(id, component)``, the smallest id reachable.

    Alternates the large-star and small-star steps until the edges are stars. Each step is one minimum
    per node with map-side combine and a join back to the edges, so a node with very many links is combined
    before the shuffle; the edges of each round are written to the staging folder. Only nodes with a link
    are returned. Number of rounds: about the logarithm of the longest chain. Edges that are stars already take none,
    and a look at the degrees, not one more round, tells that the last one was the last.
    """
    big, small = F.greatest(left, right), F.least(left, right)
    current = stage(
        edges.where(F.col(left) != F.col(right)).select(big.alias("u"), small.alias("v")).distinct(), "edges"
    )

    while not _are_stars(current):
        both = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        # Not more rows than edges; those that repeat go with the repeats of the small stars.
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(least, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        current = stage(star.select("e.u", "e.v").where("u <> v").distinct(), "edges")
    # Every node now points at the smallest id of its component, once.
    star = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return star.unionByName(roots)


def _are_stars(edges: DataFrame) -> bool:
    """Whether distinct edges ``(u, v)``, ``u > v``, are stars around their smallest ids: no node has two ``v``, or is both."""
    up = edges.select(F.col("u").alias("id"), F.lit(1).alias("_up"), F.lit(0).alias("_down"))
    down = edges.select(F.col("v").alias("id"), F.lit(0).alias("_up"), F.lit(1).alias("_down"))
    degrees = up.unionByName(down).groupBy("id").agg(F.sum("_up").alias("_up"), F.max("_down").alias("_down"))
    return degrees.agg(F.count(F.when(F.col("_up") + F.col("_down") > 1, 1))).first()[0] == 0


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, *, key: str, text: str, held_out: int = 5
) -> DataFrame:
    """Texts and labels to learn from: ``(text, label, share)``, at most about ``per_class`` keys a class.

    Only keys whose ``crc32`` as text modulo ``held_out`` is not 0 count. Keys come in by a hash of their own,
    so the choice does not depend on the layout; ``share`` is the part of the class that was kept, for weights.
    Keys with no label or with two different ones teach nothing. The bounded list of keys is what is broadcast.
    """
    known = (
        labels.where(fold(F.col(key), held_out) != 0)
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(label).alias("_label"), F.max(label).alias("_most"))
        .where((F.col("_label") == F.col("_most")) & F.col("_label").isin(0, 1))
        .select("_key", F.col("_label").cast("int").alias("_label"))
    )
    share = {r[0]: min(1.0, per_class / r[1]) for r in known.groupBy("_label").count().collect()}
    part = F.when(F.col("_label") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0))
    drawn = F.pmod(F.xxhash64(F.col("_key"), F.lit("sample")), F.lit(1 << 20)) < part * (1 << 20)
    keys = known.withColumn("_share", part).where(drawn)
    texts = docs.select(F.col(key).alias("_of"), F.col(text).alias("text"))
    return texts.join(F.broadcast(keys), F.col("_of") == F.col("_key")).select(
        "text", F.col("_label").alias("label"), F.col("_share").alias("share")
    )
