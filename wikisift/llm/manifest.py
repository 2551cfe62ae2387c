"""Operator 11: Merkle manifest of a corpus, proofs included.

A row's leaf is the hash of its length-prefixed fields.  The leaves of a language,
in order, are cut into aligned blocks of ``fanout ** LEVELS``; a block keeps every
level of its own part of the tree as one string of digests, 64 characters each.
A level's parents are the hashes of fixed-width substrings of the string below,
and a node's siblings are the substrings that flank it in its run.  The blocks'
roots are the leaves of the next, far smaller table, which is cut and hashed in
the same way, until one digest a language remains; the languages' digests,
in order, are the leaves of the last tree.

Leaves are numbered by a range shuffle of narrow rows (no text), in which equal rows
are told apart by a row number, so neither a language nor a doc_id with a third of
all rows meets in one task; a block is a bounded group.  Leaves, numbered leaves
and blocks are written, so that a lost executor costs its running tasks alone.

Defined results: a null field is ``-``; empty and very long texts are hashed whole;
null languages are one language, the first; within a language null doc_ids come first
and rows that repeat a doc_id follow each other by leaf, so equal rows have neighbouring places; an
empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikisift.llm.common import persisted
from wikisift.operators.ordering import dense_index

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a node, and levels of the tree that one block holds.
FANOUT, LEVELS = 2, 8
#: Characters of a digest.
WIDTH = 64


def field(value: Column) -> Column:
    """A value in the form that is hashed: ``-`` or UTF-8 length, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, digest, lambda at, s: F.sha2(F.concat(s["before"], at, s["after"]), 256))


def height(n: Column, fanout: int) -> Column:
    """Levels above the leaves of a tree with ``n`` leaves."""
    powers, p = [], 1
    while p < 1 << 62:
        powers.append(p)
        p *= fanout
    return F.size(F.filter(F.array(*map(F.lit, powers)), lambda x: x < n))


def _up_to(n: Column) -> Column:
    """0, 1, ... n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def _parents(level: Column, fanout: int) -> Column:
    """The level above: one digest for each run of ``fanout``."""
    run = WIDTH * fanout
    runs = F.ceil(F.length(level) / run)
    hashed = F.transform(_up_to(runs), lambda k: F.sha2(F.substring(level, k * run + 1, F.lit(run)), 256))
    return F.array_join(hashed, "").cast("binary")  # binary: its substrings are found without a walk


def _block_levels(digests: Column, levels: Column, fanout: int) -> Column:
    """The level strings of a block, leaves first."""
    bottom = F.array(F.array_join(digests, "").cast("binary"))
    return F.aggregate(_up_to(levels), bottom, lambda acc, _: F.concat(acc, F.array(_parents(F.element_at(acc, -1), fanout))))


def _siblings(levels: Column, pos: Column, height_: Column, fanout: int) -> Column:
    """The segments that flank a leaf's ancestors, level by level."""
    def flank(k):
        at = F.floor(pos / F.pow(F.lit(fanout), k)).cast("int")
        first = at - at % fanout
        level = F.element_at(levels, k + 1)
        return F.struct(F.substring(level, first * WIDTH + 1, (at - first) * WIDTH).cast("string").alias("before"),
                        F.substring(level, (at + 1) * WIDTH + 1, (first + fanout - at - 1) * WIDTH).cast("string").alias("after"))

    return F.transform(_up_to(height_), flank)


_PROOF = "array<struct<before:string,after:string>>"


def _blocks(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(grp, block, n, height, root, members) of the nodes' aligned blocks, written.

    ``nodes``: grp, pos (0 .. n - 1 in its grp), n, digest, row (a struct that goes along).
    """
    size = fanout**levels
    cut = nodes.groupBy("grp", F.floor(F.col("pos") / size).alias("block")).agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct((F.col("pos") % size).cast("int").alias("pos"), "digest", "row"))).alias("members"))
    cut = cut.withColumn("height", F.least(F.lit(levels), height(F.col("n"), fanout)))
    top = _block_levels(F.col("members.digest"), F.col("height"), fanout)
    return persisted(cut.withColumn("root", F.element_at(top, -1).cast("string")), "merkle-blocks")


def _opened(blocks: DataFrame, upper: DataFrame, fanout: int) -> DataFrame:
    """The members of ``blocks`` as rows again, each with its whole proof.

    ``upper``: grp, block, proof (above the block) and further columns, which are kept.
    """
    kept = [c for c in upper.columns if c not in ("grp", "block", "proof")]

    def members(levels):
        return F.transform("members", lambda m: F.struct(m["row"].alias("row"), m["digest"].alias("digest"), _siblings(levels, m["pos"], F.col("height"), fanout).alias("own")))

    # one-element array: a block's levels are built once, not once a member
    opened = F.element_at(F.transform(F.array(_block_levels(F.col("members.digest"), F.col("height"), fanout)), members), 1)
    rows = blocks.drop("root").join(upper, ["grp", "block"]).select("grp", "proof", *kept, F.explode(opened).alias("m"))
    return rows.select("grp", "m.row", "m.digest", F.concat("m.own", "proof").alias("proof"), *kept)


def _tree(nodes: DataFrame, most: int, fanout: int, levels: int) -> DataFrame:
    """(grp, row, digest, proof, top) of every node; ``most``: the largest n."""
    if most <= 1:
        return nodes.select("grp", "row", "digest", F.array().cast(_PROOF).alias("proof"), F.col("digest").alias("top"))
    blocks = _blocks(nodes, fanout, levels)
    return _opened(blocks, _above(blocks, most, fanout, levels), fanout)


def _above(blocks: DataFrame, most: int, fanout: int, levels: int) -> DataFrame:
    """(grp, block, proof, top) of every block: the tree over the blocks' roots."""
    size = fanout**levels
    roots = blocks.select("grp", F.col("block").alias("pos"), F.ceil(F.col("n") / size).alias("n"), F.col("root").alias("digest"), F.struct("block").alias("row"))
    return _tree(roots, -(-most // size), fanout, levels).select("grp", "row.block", "proof", "top")


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, carry: dict[str, Column] | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """doc_id, lang, leaf, proof, subroot and root of every row.

    ``proof``: segments (before, after) of sibling digests from the leaf to the root, which
    :func:`fold` takes.  ``carry``: further columns, computed beside the leaves.
    """
    carry = carry or {}
    key = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-"))  # '-' sorts before '='
    row = F.struct("doc_id", "lang", *(c.alias(k) for k, c in carry.items()))
    narrow = docs.select(key.alias("grp"), F.col("doc_id").alias("ord"), leaf(*(F.col(f) for f in fields)).alias("digest"), row.alias("row"), F.monotonically_increasing_id().alias("uid"))
    placed = dense_index(persisted(narrow, "merkle-leaves"), ["grp", "ord", "digest", "uid"])
    sizes = placed.groupBy("grp").agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("n"))
    sizes = persisted(sizes, "merkle-sizes")
    most = sizes.agg(F.max("n")).first()[0] or 0
    nodes = placed.join(sizes, "grp").select("grp", (F.col("idx") - F.col("first")).alias("pos"), "n", "digest", "row")
    blocks = _blocks(nodes, fanout, levels)
    above = persisted(_above(blocks, most, fanout, levels), "merkle-above")
    tops = dense_index(above.where("block = 0").select("grp", "top"), ["grp"])
    groups = tops.count() if most else 0
    tops = tops.select(F.lit("").alias("grp"), F.col("idx").alias("pos"), F.lit(groups).cast("long").alias("n"), F.col("top").alias("digest"), F.struct("grp").alias("row"))
    roots = _tree(tops, groups, fanout, levels).select(F.col("row.grp").alias("grp"), F.col("proof").alias("rest"), F.col("top").alias("root"))
    upper = above.join(roots, "grp").select("grp", "block", F.concat("proof", "rest").alias("proof"), F.col("top").alias("subroot"), "root")
    return _opened(blocks, upper, fanout).select("row.doc_id", "row.lang", F.col("digest").alias("leaf"), "proof", "subroot", "root", *(F.col("row")[k].alias(k) for k in carry))


def audit(docs: DataFrame, every: int = 7) -> DataFrame:
    """The manifest as digests, and a tampering test: rows whose doc_id's CRC-32 ``every``
    divides get one more in n_chars, and the root is folded anew from that leaf."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    changed = leaf(*((F.col(f).cast("decimal(20,0)") + 1 if f == "n_chars" else F.col(f)) for f in FIELDS))
    rows = manifest(docs, carry={"tampered": F.when(hit, changed)})
    parts = F.flatten(F.transform("proof", lambda s: F.array(s["before"], s["after"])))
    rows = rows.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(parts, ""), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
