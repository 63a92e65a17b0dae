"""Merkle manifest of a dataset: a digest per row, a tree over each language, a root over all.

A row is a leaf, the digest of its fields. Leaves of a language stand in a line by id; of every
eight nodes in a row the next level has one, their digest, until one is left. The last nodes
of the languages are the leaves of one more tree.

A level is a table of nodes numbered along their line. Fixed-offset lag and lead columns,
masked by a node's slot in its run of eight and by the length of that run, hold its siblings;
the row of a run's first child hashes the parent. A run never crosses a multiple of eight, so
windows are cut at multiples of ``BLOCK`` nodes: no language, however large, is one window.
Leaves are numbered by one range sort: a node's number is its place in its task's share plus
the nodes of its line in earlier shares. Every level is written, and only the level below it is
read again for the proofs, which go down from the root: a node's path is its siblings and
its parent's path, so a level of n nodes joins n/8 rows.

Edge cases: a null field is told from every value, an empty text from a null one. Leaves without
id come first; rows with equal ids stand by their digest, and rows that are equal throughout are
leaves of their own that may change places. Rows without language form a tree of their own,
before all others. A lone leaf is its tree's root, and a lone tree's root is the root of all. An
empty table gives an empty result. Columns other than the fields are not read, so theirs
may have any names.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from rampline.llm.common import small, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 8
BLOCK = FANOUT**4
ROWS_PER_TASK = 2_000_000

_PATH = "array<struct<before:string,after:string>>"


def digest(*inputs: Column) -> Column:
    """Lowercase hex SHA-256 of the inputs' UTF-8 bytes end to end."""
    return F.sha2(F.concat(*inputs).cast("binary"), 256)


def field(value: Column) -> Column:
    """A field as it enters the digest of its row: a dash if null, else its length and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(row: dict[str, Column]) -> Column:
    return digest(*(field(row[name]) for name in FIELDS))


# ---- numbering ------------------------------------------------------------------------


def numbered(nodes: DataFrame, line: str, order: list[str]) -> DataFrame:
    """``nodes`` with ``pos``, their place along their ``line`` by ``order``, and ``n``, the line's length.

    A line that holds most nodes is spread over many tasks, also if many of its nodes tie.
    """
    n_rows = nodes.count()
    parts = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_rows // ROWS_PER_TASK)
    columns = nodes.columns
    keys = [line, *order, "tie"]
    placed = (
        nodes.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .select(*columns, F.monotonically_increasing_id().alias("place"))
    )
    placed = written(placed, "merkle-order")  # a task's share in the high bits of the place, the row in the low ones
    share = F.shiftright("place", 33)
    shares = placed.groupBy(line, share.alias("share")).agg(F.count(F.lit(1)).alias("held"), F.min("place").alias("first"))
    along = Window.partitionBy(line).orderBy("share")
    shares = written(
        shares.select(
            line,
            "share",
            "first",
            (F.sum("held").over(along) - F.col("held")).alias("earlier"),
            F.sum("held").over(Window.partitionBy(line)).alias("n"),
        ),
        "merkle-shares",
    )
    keyed = small(shares.withColumnRenamed(line, "of"), shares.count())
    return placed.join(keyed, (F.col(line) == F.col("of")) & (share == F.col("share"))).select(
        *columns, (F.col("place") - F.col("first") + F.col("earlier")).alias("pos"), "n"
    )


# ---- levels ---------------------------------------------------------------------------


def with_siblings(nodes: DataFrame, line: str) -> DataFrame:
    """``nodes`` with their earlier and later siblings' digests, each end to end."""
    near = Window.partitionBy(line, F.floor(F.col("pos") / BLOCK)).orderBy("pos")
    slot = F.col("pos") % FANOUT
    run = F.least(F.lit(FANOUT), F.col("n") - F.col("pos") + slot)
    before = [F.when(slot >= k, F.lag("node", k).over(near)) for k in range(FANOUT - 1, 0, -1)]
    after = [F.when(slot + k < run, F.lead("node", k).over(near)) for k in range(1, FANOUT)]
    return nodes.withColumns({"before": F.concat_ws("", *before), "after": F.concat_ws("", *after)})


def parents(level: DataFrame, line: str) -> DataFrame:
    """The next level: each run's digest, made by the row of its first child."""
    first = level.where((F.col("pos") % FANOUT == 0) & (F.col("n") > 1))
    return first.select(
        line,
        F.expr(f"pos div {FANOUT}").alias("pos"),
        F.ceil(F.col("n") / FANOUT).cast("long").alias("n"),
        digest(F.col("node"), F.col("after")).alias("node"),
    )


def grown(nodes: DataFrame, line: str) -> list[DataFrame]:
    """All levels of the trees over ``nodes`` (line, pos, n, node and more), as tables, the leaves first."""
    levels = [written(with_siblings(nodes, line), "merkle-level")]
    while levels[-1].agg(F.max("n")).first()[0] not in (None, 1):
        levels.append(written(with_siblings(parents(levels[-1], line), line), "merkle-level"))
    return levels


def tops(levels: list[DataFrame], line: str) -> DataFrame:
    """(line, top): the last node of each line."""
    found = [level.where("n = 1").select(line, F.col("node").alias("top")) for level in levels]
    top = found[0]
    for more in found[1:]:
        top = top.unionByName(more)
    return top


def with_paths(levels: list[DataFrame], line: str) -> DataFrame:
    """The leaves with ``path``: the siblings on the way to the top of their line."""
    down = None
    for level in reversed(levels):
        own = F.when(F.col("n") > 1, F.array(F.struct("before", "after"))).otherwise(F.array().cast(_PATH))
        level = level.withColumn("own", own.cast(_PATH)).drop("before", "after")
        if down is None:
            down = level.withColumnRenamed("own", "path")
            continue
        above = down.select(F.col(line).alias("of"), F.col("pos").alias("at"), F.col("path").alias("above"))
        joined = level.join(above, (F.col(line) == F.col("of")) & (F.expr(f"pos div {FANOUT}") == F.col("at")), "left")
        # a line that ends here has a node of its own, and no parent, in no level above
        path = F.concat("own", F.when(F.col("n") > 1, F.coalesce("above", F.array().cast(_PATH))).otherwise(F.array().cast(_PATH)))
        down = joined.withColumn("path", path).drop("of", "at", "above", "own")
    return down


def folded(node: Column, path: Column) -> Column:
    """The root that a node and its siblings give."""
    return F.aggregate(path, node, lambda held, step: digest(step["before"], held, step["after"]))


def siblings(path: Column) -> Column:
    """All siblings' digests, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


# ---- manifest -------------------------------------------------------------------------


def manifest(docs: DataFrame, claimed_text: Column | None = None) -> DataFrame:
    """Per row its leaf, its tree's and the dataset's root, its path, and the verdict on its claim.

    ``path`` holds the siblings of every level. ``claimed_text``, an expression over the fields,
    is the text of a copy that claims to be the row: ``folded_root`` is the root by that copy's
    leaf and the row's siblings, ``verified`` whether it is the dataset's root.
    """
    row = {name: F.col(name) for name in FIELDS}
    claim = leaf_of(row | {"text": row["text"] if claimed_text is None else claimed_text})
    leaves = written(
        docs.select(
            "doc_id",
            # null sorts first, and values by their bytes
            F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("line"),
            leaf_of(row).alias("node"),
            claim.alias("claim"),
        ),
        "merkle-leaves",
    )
    trees = grown(numbered(leaves, "line", ["doc_id", "node"]), "line")
    subroots = written(tops(trees, "line").select(F.lit(0).alias("all"), "line", F.col("top").alias("node")), "merkle-subroots")
    forest = grown(numbered(subroots, "all", ["line"]), "all")
    root = F.broadcast(tops(forest, "all").withColumnRenamed("top", "root"))  # one row
    lines = with_paths(forest, "all").join(root, "all")
    lines = lines.select(F.col("line").alias("of"), F.col("node").alias("subroot"), F.col("path").alias("upper"), "root")
    lines = written(lines, "merkle-lines")
    paths = with_paths(trees, "line").join(small(lines, lines.count()), F.col("line") == F.col("of"))
    path = F.concat("path", "upper")
    return paths.select("doc_id", F.col("node").alias("leaf"), "claim", "subroot", "root", path.alias("path")).withColumn(
        "folded_root", folded(F.col("claim"), F.col("path"))
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def proofs(docs: DataFrame, claimed_text: Column | None = None) -> DataFrame:
    """``manifest`` with a digest of each row's path in its place."""
    found = manifest(docs, claimed_text)
    return found.select(
        "doc_id", "leaf", "subroot", "root", digest(siblings(F.col("path"))).alias("proof_sha256"), "folded_root", "verified"
    )


def tampered_text() -> Column:
    """The text as a careless copy has it: A-Z in lower case, in every third document by its id's CRC-32."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(third, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
