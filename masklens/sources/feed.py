"""Activity feed pages.

The original pulls a paged REST feed. Here the pages are JSON files already
landed; they are read with a fixed schema, nested objects are flattened to
``a.b`` columns and mapped onto the sixteen text columns of the feed table.

A paged feed is a chain: every page's ``Link`` header names the next one. Pages
landed with their headers are put back into chain order by list ranking
(pointer doubling), which also tells whether a chain is complete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from masklens import schemas
from masklens.session import ensure_checkpoint_dir

FLATTEN_DELIMITER = "."
# A link of a Link header: its target, then its parameters up to the next link.
LINK = r"<([^>]*)>([^<]*)"
REL_NEXT = r"""(?i);\s*rel\s*=\s*("([^"]*\s)?next(\s[^"]*)?"|next(?![^\s;,]))"""


# Records without nesting: every field of the feed table as text.
FLAT_RECORD = StructType([StructField(name, StringType()) for name in schemas.FEED_FIELDS])


def read_feed_pages(spark: SparkSession, folder: str, schema: StructType | str = FLAT_RECORD,
                    mode: str = "array") -> DataFrame:
    """Landed feed pages of a fixed schema, by default flat text records.

    ``mode`` says what a file is: ``array`` is one JSON array (or one record)
    per file, ``lines`` one record per line. Neither can be read as the other:
    a reader of whole files stops after the first record of a file of lines.
    """
    if mode not in ("array", "lines"):
        raise ValueError(f"mode {mode!r} is neither 'array' nor 'lines'")
    return spark.read.schema(schema).option("multiLine", mode == "array").json(folder)


def _leaves(dtype: DataType, path: list[str]):
    if isinstance(dtype, StructType):
        for f in dtype.fields:
            yield from _leaves(f.dataType, path + [f.name])
    elif isinstance(dtype, (ArrayType, MapType)):
        return  # arrays and maps are not kept as text
    else:
        yield path


def flatten(df: DataFrame, delimiter: str = FLATTEN_DELIMITER) -> DataFrame:
    """nested struct fields become columns named by their path."""
    cols = []
    for path in _leaves(df.schema, []):
        ref = ".".join(f"`{p}`" for p in path)
        cols.append(F.col(ref).alias(delimiter.join(path)))
    return df.select(*cols)


def map_columns(df: DataFrame, mapping: list[tuple[str, str]] | None = None) -> DataFrame:
    """F6 + F9: (source, sink) mappings onto the feed table's text columns.

    Sinks without a present source are null; every value is cast to text.
    """
    return df.select(*_mapped(df, mapping))


def _mapped(df: DataFrame, mapping: list[tuple[str, str]] | None) -> list[Column]:
    if mapping is None:
        mapping = [(name, name) for name in schemas.FEED_FIELDS]
    present = set(df.columns)
    by_sink = {sink: src for src, sink in mapping}
    cols = []
    for sink in schemas.FEED_FIELDS:
        src = by_sink.get(sink)
        if src is not None and src in present:
            cols.append(F.col(f"`{src}`").cast("string").alias(sink))
        else:
            cols.append(F.lit(None).cast("string").alias(sink))
    return cols


def feed_rows(pages: DataFrame, mapping: list[tuple[str, str]] | None = None) -> DataFrame:
    """S8 -> F7 -> F6: landed pages as rows of the feed table."""
    return map_columns(flatten(pages), mapping)


def linked_page_schema(record: StructType) -> StructType:
    """A landed page: its address, its ``Link`` header and its records."""
    return StructType([StructField("page", StringType()), StructField("link", StringType()),
                       StructField("records", ArrayType(record))])


def next_link(header: Column) -> Column:
    """The target of the first link with relation ``next`` in a ``Link`` header, or null."""
    links = F.arrays_zip(F.regexp_extract_all(header, F.lit(LINK), 1).alias("target"),
                         F.regexp_extract_all(header, F.lit(LINK), 2).alias("told"))
    return F.get(F.filter(links, lambda x: x["told"].rlike(REL_NEXT)), 0)["target"]


def page_chains(pages: DataFrame, page: str = "page", next_page: str = "next") -> DataFrame:
    """Where every landed page stands in its chain of ``next`` links.

    One row per page address: ``page``, ``next``, ``chain`` (the chain's first page), ``page_rank`` (from 0), ``status`` and
    ``missing``. ``status`` is ``complete`` (the chain ends with a page without a next one), ``broken`` (it ends with a page
    whose next one has not landed: ``missing``), ``merged`` (several pages name the same next page; pages
    are ranked by their distance from the end, the chain is the furthest page, the first by name of several) or ``cyclic`` (no
    first page: ``chain`` is the cycle's first page by name, without rank). A page landed several times counts once, with
    the link it has (the first by name if they differ); rows without an address are left out.

    List ranking by pointer doubling: every round doubles the distance each pointer spans, so a chain of n pages takes
    log2(n) rounds of one equi-join each, whatever its length. Pages are numbered in the order of their names, and rounds move
    numbers only, in as many partitions as the join has. Each round is checkpointed (reliable, in the session's checkpoint
    folder) and one count reaches the driver.
    """
    ensure_checkpoint_dir(pages.sparkSession)
    nodes = (pages.where(F.col(page).isNotNull()).groupBy(F.col(page).alias("page")).agg(F.min(next_page).alias("next"))
             .orderBy("page").withColumn("id", F.monotonically_increasing_id()).checkpoint())
    known = nodes.select(F.col("page").alias("follower"), F.col("id").alias("far"))
    # far: the page that ``hops`` links lead to; low: the first page by name among those passed
    at = nodes.join(known, nodes["next"] == known["follower"], "left").select(
        "id", F.coalesce("far", "id").alias("far"), F.col("far").isNotNull().cast("long").alias("hops"),
        F.col("far").isNull().alias("ended"), F.col("id").alias("low")).checkpoint()
    span, before, running = 1, None, at.where("not ended").count()
    # pages that have an end reach it one after the other, so that a round in which none did leaves cycles and what leads into
    # them; a pointer that spans as many pages as are left stands inside a cycle, and that page's pointer has passed all of it
    while running and not (running == before and span >= running):
        there = at.select(F.col("id").alias("via"), F.col("far").alias("far2"), F.col("hops").alias("hops2"),
                          F.col("ended").alias("ended2"), F.col("low").alias("low2"))
        # a page that reached its end looks up a number that no page has
        via = F.when(F.col("ended"), -1 - F.col("id")).otherwise(F.col("far"))
        at = at.join(there, via == F.col("via"), "left").select(
            "id", F.coalesce("far2", "far").alias("far"), (F.col("hops") + F.coalesce("hops2", F.lit(0))).alias("hops"),
            F.coalesce("ended2", "ended").alias("ended"), F.least("low", "low2").alias("low")).checkpoint()
        span, before, running = 2 * span, running, at.where("not ended").count()
    # chains with an end: one row each, summed before the shuffle
    name = nodes.select(F.col("id").alias("first"), F.col("page").alias("chain"))
    ends = (at.where("ended").groupBy("far").agg(F.max("hops").alias("last"), F.count(F.lit(1)).alias("pages"),
                                                 F.min(F.struct((-F.col("hops")).alias("back"), "id"))["id"].alias("first"))
            .join(nodes.select(F.col("id").alias("far"), F.col("next").alias("missing")), "far").join(name, "first"))
    status = (F.when(F.col("pages") > F.col("last") + 1, "merged").when(F.col("missing").isNotNull(), "broken")
              .otherwise("complete"))
    ranked = at.where("ended").join(ends, "far").select(
        "id", "chain", (F.col("last") - F.col("hops")).alias("page_rank"), status.alias("status"), "missing")
    cycles = at.where("not ended").select(F.col("id").alias("far"), F.col("low").alias("first"))
    cyclic = at.where("not ended").select("id", "far").join(cycles, "far").join(name, "first").select(
        "id", "chain", F.lit(None).cast("long").alias("page_rank"), F.lit("cyclic").alias("status"),
        F.lit(None).cast("string").alias("missing"))
    return nodes.join(ranked.unionByName(cyclic), "id").select("page", "next", "chain", "page_rank", "status", "missing")


def chain_report(chains: DataFrame) -> DataFrame:
    """One row per chain of :func:`page_chains`: its pages, how it ends, and the page that is missing."""
    return chains.groupBy("chain", "status", "missing").agg(F.count(F.lit(1)).alias("pages"))


def chain_records(pages: DataFrame, chains: DataFrame, mapping: list[tuple[str, str]] | None = None) -> DataFrame:
    """S8 -> F7 -> F6 in chain order: the feed's sixteen columns of every record of linked pages (``page``, ``records``), with
    ``chain``, ``page_rank`` and ``position`` in the page. A page landed twice gives its records twice, as an append does."""
    placed = pages.where(F.col("page").isNotNull()).select("page", "records").join(chains.select("page", "chain", "page_rank"), "page")
    placed = placed.select("chain", "page_rank", F.posexplode("records").alias("position", "record"))
    order = ["chain", "page_rank", "position"]
    flat = flatten(placed.select(F.struct(*order).alias("_at"), "record.*"))
    return flat.select(*_mapped(flat, mapping), *[F.col(f"`_at.{c}`").alias(c) for c in order])
