"""What several operators share: staging in the cluster's shared folder and connected components."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: A word, as every operator on words reads it: a run of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


class Staging:
    """Intermediate tables of one run, as Parquet in the folder ``spark.checkpoint.dir`` names.

    Written tables cut the lineage and outlive lost executors. This setting is never changed; where it is
    absent, a session on one machine (tests) uses a temporary folder and any other raises an error. Spark's
    setting that deletes shuffle files is on while a table is written.
    All tables that are left are deleted when the driver's Python ends.
    """

    def __init__(self, spark: SparkSession):
        base = spark.conf.get(CHECKPOINT_DIR, None)
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError(f"{CHECKPOINT_DIR} must name a folder that the driver and all executors share")
            base = tempfile.mkdtemp(prefix="staging-")
        self.spark = spark
        self.folder = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
        atexit.register(_delete, spark, self.folder)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the stored table; what the job shuffled is deleted as soon as it is written."""
        path, conf = f"{self.folder}/{name}", self.spark.conf
        before = conf.get(SHUFFLE_CLEANUP)
        conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            conf.set(SHUFFLE_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table nothing reads any more."""
        _delete(self.spark, f"{self.folder}/{name}")

    def clear(self) -> None:
        """Delete all tables; nothing reads them any more."""
        _delete(self.spark, self.folder)


def _delete(spark: SparkSession, folder: str) -> None:
    if spark._jvm is None:
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Column that tells rows apart where they share a key.
ROW_KEY = "__row_key"


def row_keys(documents: DataFrame, key: str, text: str, staging: Staging) -> tuple[DataFrame, DataFrame | None]:
    """``documents`` with a ``ROW_KEY`` for each distinct (key, text), and ``(ROW_KEY, key)`` of these.

    Row keys ascend with the key and are NULL where it is. Where no two rows share a key, which is all that
    is looked at first, they are the keys themselves, and there is no second table.
    """
    known = documents.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("k"), F.xxhash64(text).alias("t"))
    if known.groupBy("k").count().where("count > 1").isEmpty():
        return documents.withColumn(ROW_KEY, F.col(key).cast("long")), None
    ordered = known.distinct().repartitionByRange("k", "t").sortWithinPartitions("k", "t")
    names = staging.keep(ordered.withColumn(ROW_KEY, F.monotonically_increasing_id()), "row-keys")
    same = (F.col(key).cast("long") == F.col("k")) & (F.xxhash64(text) == F.col("t"))
    return documents.join(names, same, "left").drop("k", "t"), names.select(ROW_KEY, "k")


def text_words(text: str) -> str:
    """SQL for the words of ``text`` as an array, empty for NULL or blank texts."""
    spaces = "concat(chr(9), chr(10), chr(11), chr(12), chr(13))"
    return f"array_remove(split(translate(coalesce({text}, ''), {spaces}, '     '), ' ', -1), '')"


def lower_ascii(text: str) -> str:
    """SQL that lower-cases A-Z only."""
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def connected_components(links: DataFrame, staging: Staging, name: str = "cc") -> DataFrame:
    """``(id, component)`` for every id that occurs in ``links(a, b)``; component: the smallest id reachable.

    Each round, an id points to the smallest of itself and its neighbours (a minimum that combines
    before the shuffle, so a hub with very many links is no single task's work), pointers are followed
    to their ends by doubling, and links become links between ends; those inside one end are done. At
    least half of the ids that still have links go in a round, and a star is done in one.
    Self-links and repeated links are harmless; links with a NULL end are ignored.
    """
    oriented = lambda df: df.where("a != b").selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct()
    edges = staging.keep(oriented(links.where("a IS NOT NULL AND b IS NOT NULL")), f"{name}-links-0")
    components, turn = None, 0
    while True:
        lowest = edges.union(edges.select("b", "a")).groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
        ends = staging.keep(lowest.selectExpr("id", "least(id, m) AS end"), f"{name}-{turn}-ends-0")
        doubled = 0
        while True:
            further = ends.selectExpr("id AS end", "end AS next")
            doubled += 1
            step = ends.join(further, "end").selectExpr("id", "next AS end", "next < end AS changed")
            stored = staging.keep(step, f"{name}-{turn}-ends-{doubled}")
            ends = stored.select("id", "end")
            staging.drop(f"{name}-{turn}-ends-{doubled - 1}")
            if stored.where("changed").isEmpty():
                break
        if components is None:
            components = ends.withColumnRenamed("end", "component")
        else:
            moved = components.join(ends.withColumnRenamed("id", "component"), "component", "left")
            components = staging.keep(moved.selectExpr("id", "coalesce(end, component) AS component"), f"{name}-{turn}")
        between = edges.join(ends.selectExpr("id AS a", "end AS ea"), "a").join(ends.selectExpr("id AS b", "end AS eb"), "b")
        turn += 1
        edges = staging.keep(oriented(between.selectExpr("ea AS a", "eb AS b")), f"{name}-links-{turn}")
        staging.drop(f"{name}-links-{turn - 1}")
        if edges.isEmpty():
            return components


def bucket_components(
    keyed: DataFrame,
    accept: Callable[[DataFrame, str], DataFrame],
    finish: Callable[[DataFrame], DataFrame],
    staging: Staging,
    slices: int = 1,
    formed: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``(id, component)`` of the ids that a link reaches, from candidates that meet in buckets.

    ``keyed(id, buckets)`` lists the buckets of each id; ids that share one are candidates.
    ``accept(pairs(a, b), name)`` returns the pairs that are links. The buckets are formed in as many
    ``slices``, one after the other, so that only one slice's buckets are shuffled at a time; of these the
    mates are stored, ids that share a bucket with another. ``formed(mates(bucket, id, hub, n))`` is called
    then and returns the mates to go on with; ``keyed`` is not read any more. Not all mates of a bucket are paired:

    1. Every id is compared with one smaller id, the smallest of its bucket that has the fewest ids. That
       joins most of a large group with one pair a member.
    2. Of all buckets, those with more than one component compare their smallest id with the smallest id
       of each other component, which is all there is to do in buckets of two.
    3. ``finish(mates(bucket, id, c, hub))`` gets the buckets whose mates still lie in different
       components ``c`` and returns all links that are missing between these.
    """
    mates = None
    for turn in range(slices):
        members = keyed.select(F.explode("buckets").alias("bucket"), "id").where(f"pmod(xxhash64(bucket), {slices}) = {turn}")
        sized = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("hub"), F.max("id").alias("high"))
        shared = staging.keep(sized.where("hub < high"), f"buckets-{turn}")
        twos = shared.where("n = 2").select("bucket", F.explode(F.array("hub", "high")).alias("id"), "hub", "n")
        larger = members.join(shared.where("n > 2").select("bucket", "hub", "n"), "bucket").select("bucket", "id", "hub", "n").distinct()
        some = staging.keep(twos.union(larger), f"mates-{turn}")
        mates = some if mates is None else mates.union(some)
        staging.drop(f"buckets-{turn}")
    if formed is not None:
        mates = formed(mates)

    def apart(components: DataFrame, name: str) -> DataFrame:
        """Mates with their components, of the buckets that have more than one."""
        known = components.withColumnRenamed("component", "c")
        labelled = mates.join(known, "id", "left").selectExpr("bucket", "id", "coalesce(c, id) AS c", "hub")
        split = labelled.groupBy("bucket").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1").select("bucket")
        return staging.keep(labelled.join(split, "bucket"), name)

    pairs = mates.where("id > hub").groupBy(F.col("id").alias("b")).agg(F.min(F.struct("n", "hub")).alias("near"))
    links = staging.keep(accept(pairs.selectExpr("near.hub AS a", "b"), "some"), "links")
    components = connected_components(links, staging, "components")
    opened = apart(components, "apart")
    if opened.isEmpty():
        return components
    others = opened.groupBy("bucket", "hub", "c").agg(F.min("id").alias("b")).where("hub < b").selectExpr("hub AS a", "b")
    links = staging.keep(accept(others.distinct(), "all"), "links-all")
    staging.drop("apart")
    if not links.isEmpty():
        components = _joined(components, links, staging, "joined")
    opened = apart(components, "open-mates")
    if opened.isEmpty():
        return components
    more = staging.keep(finish(opened), "more-links")
    return components if more.isEmpty() else _joined(components, more, staging, "rejoined")


def distinct_buckets(mates: DataFrame, order: str) -> DataFrame:
    """``mates`` without the buckets that hold the same ids as another one: of such, the first by ``order`` is left.

    Equal sets are told by their size, smallest and largest id and two sums of 31 bits of the ids' hashes.
    """
    sums = [f"sum({part}) AS s{i}" for i, part in enumerate(("xxhash64(id) & 2147483647L", "shiftrightunsigned(xxhash64(id), 33)"))]
    sets = mates.groupBy("bucket").agg(*[F.expr(x) for x in ("count(1) AS size", "min(id) AS low", "max(id) AS high", *sums)])
    first = sets.groupBy("size", "low", "high", "s0", "s1").agg(F.min(F.struct(F.expr(order).alias("o"), "bucket")).alias("first"))
    return mates.join(first.select("first.bucket"), "bucket")


def _joined(components: DataFrame, links: DataFrame, staging: Staging, name: str) -> DataFrame:
    """Components after more links: only the components that the links touch are joined."""
    left, right = components.selectExpr("id AS a", "component AS ca"), components.selectExpr("id AS b", "component AS cb")
    ends = links.join(left, "a", "left").join(right, "b", "left").selectExpr("coalesce(ca, a) AS a", "coalesce(cb, b) AS b")
    merged = connected_components(ends, staging, f"{name}-merged").toDF("was", "now")
    linked = links.selectExpr("explode(array(a, b)) AS id").distinct()
    everyone = components.union(linked.selectExpr("id", "id AS component"))
    everyone = everyone.groupBy("id").agg(F.min("component").alias("was"))
    return staging.keep(everyone.join(merged, "was", "left").selectExpr("id", "coalesce(now, was) AS component"), name)
