"""Merkle fixity audit of WARC replicas.

A manifest lists the records of an archive: file, place in the file, byte range. Each
replica's records are hashed, and the hashes of up to ``FANOUT`` neighbours in order, with
the offsets that they span, are hashed into a node of the next level, up to one root per
replica. Replicas whose roots agree hold the same bytes. Where they differ, the audit goes
down level by level and reads only the children of nodes that differ, to the damaged
records.

Every level is one aggregation of at most ``FANOUT`` rows a group; levels are written, so
that the way down reads hashes and no records.

Defined results: a record that a replica lacks has a mark that is no hash and is ``missing``,
one of other bytes, none included, is ``changed``, one that the manifest does not list is ``extra``; null
bytes are empty bytes; records listed twice are counted by their hashes, and the sum of the
hashes of those counts is hashed, whatever their order;
records with a null id are no records of the manifest; two empty archives agree; other
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import stage

FANOUT_BITS = 4
FANOUT = 1 << FANOUT_BITS
ABSENT = "absent"  # in place of a hash; no bytes have it
FILE_BITS = 12  # a file has at most 4,096 places


def warc_record(url: Column, record_id: Column, payload: Column) -> Column:
    """The bytes of a resource record."""
    body = F.coalesce(payload, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n")).cast("binary")


def manifest(records: DataFrame, record_id: str = "record_id", size: str = "size") -> DataFrame:
    """``record_id, file, place, begin, end``: records in order of id, 4,096 ids to a file.

    Offsets are running sums inside a file, so no group exceeds a file.
    """
    rows = records.filter(F.col(record_id).isNotNull()).groupBy(F.col(record_id).alias("record_id")).agg(F.sum(size).alias("size"))
    rows = rows.withColumn("file", F.shiftright(F.col("record_id"), FILE_BITS))
    line = Window.partitionBy("file").orderBy("record_id")
    end = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0))
    return rows.select(
        "record_id", "file", F.row_number().over(line).cast("bigint").alias("place"), (end - F.col("size")).alias("begin"), end.alias("end")
    )


def leaves(listed: DataFrame, records: DataFrame, record_id: str = "record_id", content: str = "content") -> DataFrame:
    """``node, begin, end, hash`` of every listed record, as this replica holds it."""
    own = records.select(F.col(record_id).alias("id"), F.sha2(F.coalesce(F.col(content), F.lit(b"")), 256).alias("hash"))
    # Counted by their bytes first, then added up, so that no id's records meet in one row.
    own = own.filter("id IS NOT NULL").groupBy("id", "hash").agg(F.count(F.lit(1)).alias("n"))
    each = F.sha2(F.concat_ws(":", "hash", F.col("n").cast("string")), 256)
    parts = [F.conv(F.substring(each, 1 + 16 * i, 16), 16, 10).cast("decimal(20,0)") for i in range(4)]
    sums = [F.sum(part).alias(f"s{i}") for i, part in enumerate(parts)]
    own = own.groupBy("id").agg(F.sum("n").alias("n"), F.min("hash").alias("hash"), *sums)
    several = F.sha2(F.concat_ws(":", F.col("n").cast("string"), *[F.col(f"s{i}").cast("string") for i in range(4)]), 256)
    held = F.when(F.col("n") > 1, several).otherwise(F.col("hash"))
    met = listed.join(own.select("id", held.alias("held")), F.col("record_id") == F.col("id"), "left")
    return met.select("node", "begin", "end", F.coalesce("held", F.lit(ABSENT)).alias("hash"))


def _parents(nodes: DataFrame) -> DataFrame:
    """Hash at most ``FANOUT`` neighbours, in order, with the range of offsets that they span."""
    children = F.array_sort(F.collect_list(F.struct("node", "begin", "end", "hash")))
    grouped = nodes.groupBy(F.shiftright("node", FANOUT_BITS).alias("parent")).agg(
        children.alias("children"), F.min("begin").alias("begin"), F.max("end").alias("end")
    )
    line = F.transform("children", lambda c: F.concat_ws(":", c["begin"].cast("string"), c["end"].cast("string"), c["hash"]))
    return grouped.select(F.col("parent").alias("node"), "begin", "end", F.sha2(F.concat_ws("|", line), 256).alias("hash"))


def tree(bottom: DataFrame, name: str = "tree") -> list[DataFrame]:
    """The levels from the records to the root, each written once."""
    levels = [stage(bottom, name)]
    top = levels[0].agg(F.max("node")).first()[0] or 0
    while top:
        levels.append(stage(_parents(levels[-1]), name))
        top >>= FANOUT_BITS
    return levels


def audit(ours: list[DataFrame], theirs: list[DataFrame]) -> DataFrame:
    """``node, begin, end, hash, other_hash`` of the records that differ, from the root down.

    Both trees are of one manifest, so they have the same nodes.
    """
    suspect = None
    for a, b in zip(reversed(ours), reversed(theirs), strict=True):
        other = b.select(F.col("node").alias("n"), F.col("hash").alias("other_hash"))
        if suspect is not None:
            near = suspect.select(F.col("node").alias("above"))
            a = a.join(near, F.shiftright("node", FANOUT_BITS) == F.col("above"), "left_semi")
            other = other.join(near, F.shiftright("n", FANOUT_BITS) == F.col("above"), "left_semi")
        suspect = a.join(other, F.col("node") == F.col("n")).filter(F.col("hash") != F.col("other_hash")).drop("n")
        suspect = stage(suspect, "suspect")
    return suspect


def damaged(records: DataFrame, replica: DataFrame, record_id: str = "record_id", content: str = "content") -> DataFrame:
    """``record_id, file, begin, end, status`` of all that is wrong with the replica."""
    sized = records.select(F.col(record_id).alias("record_id"), F.coalesce(F.octet_length(content), F.lit(0)).alias("size"))
    listed = stage(manifest(sized), "manifest")
    first = listed.agg(F.min("file")).first()[0] or 0
    node = F.shiftleft(F.col("file") - first, FILE_BITS).bitwiseOR(F.col("place") - 1)
    listed = listed.withColumn("node", node)
    found = audit(tree(leaves(listed, records, record_id, content), "ours"), tree(leaves(listed, replica, record_id, content), "theirs"))
    wrong = (
        found.select("node", "other_hash")
        .join(listed, "node")
        .select("record_id", "file", "begin", "end", F.when(F.col("other_hash") == ABSENT, "missing").otherwise("changed").alias("status"))
    )
    extra = (
        replica.select(F.col(record_id).alias("record_id"))
        .filter("record_id IS NOT NULL")
        .distinct()
        .join(listed.select("record_id"), "record_id", "left_anti")
        .select("record_id", *[F.lit(None).cast("bigint").alias(c) for c in ("file", "begin", "end")], F.lit("extra").alias("status"))
    )
    return wrong.unionByName(extra)
