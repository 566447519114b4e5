"""Operator 2: fixity audit of WARC replicas by hash trees.

Pages become WARC records, laid in order of their id into files of
``FILE_IDS`` ids; a record has an offset and a length in its file. Each record
is hashed, and ordered ranges of ``FANOUT`` ids, of ``FANOUT`` such ranges and
so on are hashed from their parts up to one root. The audit compares the roots
of two replicas and then descends level by level, only below nodes whose hashes
differ, to the damaged records.

Hashes of both replicas are made in one job and written; nothing but the number
of levels reaches the driver. A range holds the ids of its numbers, not a count
of records, so a lost record does not shift its neighbours.

Defined results: null texts and urls make empty fields. Rows of one id are one leaf
(its different contents with their numbers of copies), so repeated rows are compared
as such. Rows without an id have no place in a file: they are dealt over
``LOST_LEAVES`` leaves by content, a tree of their own, and every content whose number
of copies differs is a row with a null id, without file, offset and length. Negative
ids are ids like others, in files of negative numbers. Replicas that agree, and
empty tables, give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

FANOUT = 16
FILE_IDS = FANOUT**3
LOST_LEAVES = 1 << 16


def record(id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> Column:
    """The WARC record of a page, as text."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(F.col(url_col), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, payload, F.lit("\r\n\r\n"))


def leaves(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(lost, leaf, sha256, bytes, copies): each different record with its number of copies; ``lost``
    marks the leaves of records without an id."""
    text = record(id_col, url_col, payload_col)
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.sha2(text.cast("binary"), 256).alias("sha256"), F.octet_length(text).cast("bigint").alias("bytes"))
    dealt = F.pmod(F.xxhash64("sha256"), F.lit(LOST_LEAVES))
    return rows.groupBy(F.col("id").isNull().alias("lost"), F.coalesce("id", dealt).alias("leaf"), "sha256", "bytes").agg(F.count("*").alias("copies"))


def _joined(order: str, part: str) -> Column:
    """Hash of some parts in their order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(order, part))), lambda x: x[part])
    return F.sha2(F.array_join(parts, "").cast("binary"), 256)


def _parent(node: str) -> Column:
    return F.shiftright(node, FANOUT.bit_length() - 1)  # FANOUT is a power of two


def tree(leaf_rows: DataFrame) -> list[DataFrame]:
    """Node tables (replica, lost, node, hash) from the leaves up to the level of one node."""
    # an id's contents are joined by the first digits of their hashes first: no long list of one id
    some = leaf_rows.groupBy("replica", "lost", "leaf", F.substring("sha256", 1, 2).alias("digits")).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "sha256", "copies"))), ",").cast("binary"), 256).alias("hash")
    )
    level = some.groupBy("replica", "lost", F.col("leaf").alias("node")).agg(_joined("digits", "hash").alias("hash"))
    levels = [written(level, "leaves")]
    ends = levels[0].agg(F.min("node").alias("lo"), F.max("node").alias("hi")).first()
    lo, hi = (ends["lo"], ends["hi"]) if ends["lo"] is not None else (0, 0)
    while lo != hi:
        up = levels[-1].groupBy("replica", "lost", _parent("node").alias("up")).agg(_joined("node", "hash").alias("hash"))
        levels.append(written(up.withColumnRenamed("up", "node"), "nodes"))
        if (lo, hi) == (-1, 0):
            break  # ids on both sides of zero: the last two nodes are both roots
        lo, hi = lo // FANOUT, hi // FANOUT
    return levels


def damaged_leaves(levels: list[DataFrame]) -> DataFrame:
    """(lost, leaf) of each leaf whose hashes differ, found from the roots down."""
    side = lambda r: F.max(F.when(F.col("replica") == r, F.col("hash")))
    bad = None
    for level in reversed(levels):
        rows = level
        if bad is not None:
            up = bad.select(F.col("lost").alias("_lost"), F.col("node").alias("_up"))
            rows = level.join(up, (_parent("node") == F.col("_up")) & (F.col("lost") == F.col("_lost")), "left_semi")
        both = rows.groupBy("lost", "node").agg(side(0).alias("a"), side(1).alias("b"))
        bad = both.filter(~F.col("a").eqNullSafe(F.col("b"))).select("lost", "node")
    return bad.select("lost", F.col("node").alias("leaf"))


def _damaged_without_id(hit: DataFrame) -> DataFrame:
    """(status, primary_sha256, replica_sha256) of each content whose number of copies differs."""
    copies = lambda r: F.sum(F.when(F.col("replica") == r, F.col("copies")))
    rows = hit.groupBy("sha256").agg(copies(0).alias("a"), copies(1).alias("b")).filter(~F.col("a").eqNullSafe(F.col("b")))
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("copies")
    held = lambda c: F.when(F.col(c).isNotNull(), F.col("sha256"))
    return rows.select(status.alias("status"), held("a").alias("primary_sha256"), held("b").alias("replica_sha256"))


def audit(
    primary: DataFrame,
    replica: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> DataFrame:
    """One row a damaged record (of one id together): id, file, status (altered, missing, extra, copies), the
    offset and length of its records in the primary's file, and the hashes of both sides' first records."""
    rows = leaves(primary, id_col, url_col, payload_col).withColumn("replica", F.lit(0)).unionByName(
        leaves(replica, id_col, url_col, payload_col).withColumn("replica", F.lit(1))
    )
    rows = written(rows, "records")
    bad = written(damaged_leaves(tree(rows)), "damaged")
    hit = rows.join(bad, ["lost", "leaf"], "left_semi")
    file = F.floor(F.col("leaf") / FILE_IDS).cast("bigint")
    mine = lambda r, c: F.when(F.col("replica") == r, c)
    # a side's contents are different ones, so their number and two sums of hashes tell sets apart
    contents = lambda r: F.struct(
        F.count(mine(r, F.lit(1))), F.bit_xor(mine(r, F.xxhash64("sha256"))), F.bit_xor(mine(r, F.hash("sha256")))
    )
    damage = (
        hit.filter(~F.col("lost"))
        .groupBy("leaf")
        .agg(
            F.sum(mine(0, F.col("copies"))).alias("n_primary"),
            F.sum(mine(1, F.col("copies"))).alias("n_replica"),
            F.min(mine(0, F.col("sha256"))).alias("primary_sha256"),
            F.min(mine(1, F.col("sha256"))).alias("replica_sha256"),
            contents(0).alias("_set0"),
            contents(1).alias("_set1"),
        )
    )
    # offsets only in the files that hold damage; a file has FILE_IDS leaves at most
    sizes = rows.filter("replica = 0 and not lost").groupBy("leaf").agg(F.sum(F.col("bytes") * F.col("copies")).alias("length")).withColumn("file", file)
    touched = damage.select(file.alias("file")).distinct()
    before = Window.partitionBy("file").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.join(touched, "file", "left_semi").withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("bigint")))
    same = F.col("_set0") == F.col("_set1")
    status = (
        F.when(F.col("n_replica").isNull(), "missing").when(F.col("n_primary").isNull(), "extra").when(same, "copies").otherwise("altered")
    )
    by_id = (
        damage.join(placed.select("leaf", "offset", "length"), "leaf", "left")
        .withColumn("status", status)
        .select(
            F.col("leaf").alias(id_col),
            F.concat(F.lit("part-"), file.cast("string")).alias("warc_file"),
            "status",
            "offset",
            "length",
            "primary_sha256",
            "replica_sha256",
        )
    )
    return by_id.unionByName(_damaged_without_id(hit.filter("lost")), allowMissingColumns=True)
