"""What several operators share: scratch tables, row identity, exact ranks, connected components."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.mapping import quoted
from tidemark.sources.staging import scratch_path

# Fixed value: the characters that separate words, as a Java character class.
BLANK = r"\x20\x09-\x0D"

FILE, AT, PATH = "row_file", "row_at", "row_path"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def saved(df: DataFrame, name: str, codec: str = "zstd", **options: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: computed once, lineage cut. ``options`` are the writer's."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove a table of ``saved`` that nothing reads any more: whatever came from it must be saved itself."""
    folders = {path.rpartition("/")[0] for path in table.inputFiles()}
    context = table.sparkSession.sparkContext
    for folder in folders:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def text_of(df: DataFrame) -> Column:
    """The text, null counting as empty."""
    return F.coalesce(df["text"].cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """What blanks separate, in order."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{BLANK}]+"))


def identified(docs: DataFrame) -> DataFrame:
    """Columns ``doc`` (all columns of ``docs``), ``row_file``, ``row_at`` and ``row_path``.

    The file (its path is the last column) and the place in it name a row even where doc_ids repeat or are null, and are the same whenever the
    rows are read. Scanned files have such names already (file and position); anything else is
    written to the shared scratch folder first.
    """

    def named(df: DataFrame) -> DataFrame:
        return df.select(
            F.struct(*[quoted(c) for c in df.columns]).alias("doc"),
            F.xxhash64(df.metadataColumn("_metadata")["file_path"]).alias(FILE),
            df.metadataColumn("_metadata")["row_index"].alias(AT),
            df.metadataColumn("_metadata")["file_path"].alias(PATH),
        )

    try:
        return named(docs)
    except AnalysisException:
        return named(saved(docs, "rows"))


# Places of a file that one bitmap covers, and the bytes of bitmaps that may be sent to every task.
PLACES, BITMAP_BYTES = 1 << 15, 64 << 20


def at_places(rows: DataFrame, places: DataFrame, there: bool, most_bytes: int = BITMAP_BYTES) -> DataFrame:
    """Rows of ``identified`` that are (or, not ``there``, are not) at one of ``places`` (row_file, row_at).

    A bitmap for every 32,768 places of a file tells exactly, inside the scan: no row is shuffled. The
    bitmaps are a table whose size is measured; beyond ``most_bytes`` (documents by the hundred
    million) it is a semi or anti join by place instead.
    """
    bit, piece = F.pmod(F.col(AT), F.lit(PLACES)), F.expr(f"{AT} div {PLACES}")
    bits = saved(
        places.select(F.col(FILE).alias("bits_file"), piece.alias("bits_piece"), bit.alias("at"))
        .groupBy("bits_file", "bits_piece")
        .agg(F.bitmap_construct_agg("at").alias("bits")),
        "places",
    )
    if bits.count() * (PLACES // 8 + 64) > most_bytes:
        joined = rows.join(places.select(FILE, AT), [FILE, AT], "left_semi" if there else "left_anti")
        return joined.select(*rows.columns)
    byte = F.conv(F.hex(F.substring("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    found = F.coalesce(F.call_function("getbit", byte, F.pmod(bit, F.lit(8)).cast("int")) == 1, F.lit(False))
    on = (F.col(FILE) == F.col("bits_file")) & (piece == F.col("bits_piece"))
    joined = rows.join(F.broadcast(bits), on, "inner" if there else "left")
    return joined.filter(found if there else ~found).select(*rows.columns)


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_totals(
    rows: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    amount: Column,
    alias: str,
    rows_per_slice: int = 1_000_000,
    hashed: bool = True,
) -> DataFrame:
    """``rows`` with the sum of ``amount`` over the rows before it within its group, exactly.

    The order within a group is that of the hash of the first two columns of ``order``, then
    ``order``: the same in every run, and as good as shuffled. Each group is cut into slices of the hash's range; sums of
    slices give where each starts, so that no task gets a whole group, however large. ``rows``
    must be cheap to read twice (a saved table).

    Without ``hashed`` the order is ``order`` itself, which begins with the number of a file and a
    place in it; slices are then stretches of ``rows_per_slice`` places of a file.
    """

    def before(column: str, window) -> Column:
        rows_before = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(rows_before), F.lit(0))

    sliced = rows.withColumn("_amount", amount)
    if hashed:
        bits = max(1, math.ceil(math.log2(max(partitions_of(rows.sparkSession), rows.count() / rows_per_slice, 2))))
        sliced = sliced.withColumn("_hash", F.xxhash64(*order[:2])).withColumn(
            "_slice", F.shiftrightunsigned("_hash", 64 - bits)
        )
        order = ["_hash", *order]
    else:
        sliced = sliced.withColumn("_slice", F.expr(f"shiftleft(bigint({order[0]}), 32) + {order[1]} div {rows_per_slice}"))
    keys = [*groups, "_slice"]
    starts = (
        sliced.groupBy(*keys)
        .agg(F.sum("_amount").alias("_sum"))
        .withColumn("_start", before("_sum", Window.partitionBy(*groups).orderBy("_slice")))
        .select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "_start")
    )
    within = Window.partitionBy(*keys).orderBy(*order)
    placed = sliced.withColumn("_within", before("_amount", within))
    on = [placed[k].eqNullSafe(starts[f"_key{i}"]) for i, k in enumerate(keys)]
    return placed.join(starts, on).select(
        *[placed[c] for c in rows.columns], (F.col("_within") + F.col("_start")).alias(alias)
    )


def components(links: DataFrame, name: str, max_rounds: int = 50) -> DataFrame:
    """``links`` (a, b: bigint) to ``node``, ``root``: the smallest node that it reaches.

    Large stars and small stars in turn: each node hands its neighbours its smallest one, until
    nothing changes; the number of rounds grows with the logarithm of the longest path. Minima
    are pre-aggregated, and both joins are plain equi-joins that adaptive execution can split, so
    that a node with very many links is no hot group. Every round's links are written to the
    shared scratch folder.
    """
    step = saved(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )

    def mark(df: DataFrame) -> tuple:
        # The set of links; equal sums of two hashes after a round mean that it changed nothing.
        return tuple(
            df.agg(
                F.count("*"),
                F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                F.sum(F.hash("b", "a").cast("long")),
            ).first()
        )

    last = mark(step)
    for _ in range(max_rounds):
        both = step.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: every larger neighbour of a node links to the node's smallest neighbour.
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node's smaller neighbours, and the node itself, link to the smallest.
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        small_links = large.join(small, "a").select(
            F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e")
        )
        step = saved(
            small_links.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).filter("a <> b").distinct(), name
        )
        now = mark(step)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("the links did not settle")
    return step.select(F.col("a").alias("node"), F.col("b").alias("root"))


# Up to 2^20 - 1 cuts.
MOST_CUT_BITS = 20


def cut_array(cuts: Sequence[tuple], kind: T.StructType) -> Column:
    """Ascending keys as one constant array, for ``cuts_before``; a bounded number of them."""
    names = kind.fieldNames()
    text = json.dumps([dict(zip(names, cut)) for cut in cuts])
    return F.from_json(F.lit(text), T.ArrayType(kind))


def cuts_before(key: Column, cuts: Column) -> Column:
    """How many of ``cuts`` are at most ``key``, by binary search."""

    def step(found: Column, size: Column) -> Column:
        return F.when(F.get(cuts, found + size - 1) <= key, found + size).otherwise(found)

    sizes = F.array(*[F.lit(1 << bit) for bit in reversed(range(MOST_CUT_BITS))])
    return F.aggregate(sizes, F.lit(0), step)
