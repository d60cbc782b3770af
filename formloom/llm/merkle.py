"""Merkle manifest of a dataset by superblock reduction: buckets of fanout^levels nodes collapse at once, their roots again."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, lower_ascii, materialize, remainder_of_id


def framed(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value; integers in decimal."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(framed, values)).cast("binary"), 256)


def joined_digest(*parts: str) -> str:
    """The digest of the concatenation of hexadecimal digests as text."""
    return sha256("".join(parts).encode()).hexdigest()


def levels_above(nodes: list[str], levels: int, fanout: int) -> list[list[str]]:
    """The nodes and all levels above them, `levels` times runs of `fanout` become their digest; a run of one does, too."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([joined_digest(*below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return out


def siblings(tree: list[list[str]], i: int, fanout: int) -> tuple[list[str], list[str]]:
    """What stands left and right of node i's ancestors, itself first, in their runs: a text for each level but the last."""
    left, right = [], []
    for nodes in tree[:-1]:
        start = i - i % fanout
        left.append("".join(nodes[start:i]))
        right.append("".join(nodes[i + 1 : start + fanout]))
        i //= fanout
    return left, right


def fold(node: str, left: Sequence[str], right: Sequence[str]) -> str:
    for a, b in zip(left, right, strict=True):
        node = joined_digest(a, node, b)
    return node


def numbered(nodes: DataFrame, group: str, order: Sequence[Column], name: str) -> DataFrame:
    """nodes with `idx`, the place from 0 in the order within its group, and `n`, the group's number of nodes; as a table.

    Rows are dealt by ranges and numbered where they lie; the counts of ranges (one row a range and group) give the places
    before them, so a group of any size is spread over all tasks and sorted once.
    """
    by = [F.col(group).asc_nulls_first(), *order]
    dealt = materialize(nodes.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part = dealt.groupBy(F.shiftright("_at", 33).alias("_part"), group).agg(F.count("*").alias("_here"), F.min("_at").alias("_first"))
    every = Window.partitionBy(group)
    ahead = every.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_here").over(ahead), F.lit(0)) - F.col("_first")
    part = part.select(F.col("_part").alias("_p"), F.col(group).alias("_g"), before.alias("_shift"), F.sum("_here").over(every).alias("n"))
    both = dealt.join(part, (F.shiftright("_at", 33) == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    out = materialize(both.withColumn("idx", F.col("_at") + F.col("_shift")).drop("_at", "_p", "_g", "_shift"), name)
    discard(dealt)
    return out


def depth(n: Column, fanout: int) -> Column:
    """Levels from n nodes to one, by comparing with powers (a logarithm may be off at them)."""
    powers = [1]
    while powers[-1] * fanout < 1 << 62:
        powers.append(powers[-1] * fanout)
    return sum((F.when(n > p, 1).otherwise(0) for p in powers), F.lit(0)).cast("int")


def bucketed(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """nodes with `up`, the levels that this reduction collapses, and `bucket`."""
    out = nodes.withColumn("up", F.least(depth(F.col("n"), fanout), F.lit(levels)))
    return out.withColumn("bucket", F.expr(f"idx div cast(pow({fanout}, up) as bigint)"))


def reductions(nodes: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """Tables (grp, idx, n, digest), from the given nodes to one node a group, each the bucket roots of the one before.

    A bucket has fanout^levels nodes at most, whatever a group's size; there are as many rounds as the logarithm of the
    largest group to that base.
    """

    def collapse(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        up = int(pdf["up"].iloc[0])
        root = levels_above(pdf["digest"].tolist(), up, fanout)[-1][0]
        n = -(-int(pdf["n"].iloc[0]) // fanout**up)
        return pd.DataFrame({"grp": [pdf["grp"].iloc[0]], "idx": [pdf["bucket"].iloc[0]], "n": [n], "digest": [root]})

    out = [nodes]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        parts = bucketed(out[-1].select("grp", "idx", "n", "digest"), fanout, levels).groupBy("grp", "bucket")
        out.append(materialize(parts.applyInPandas(collapse, "grp string, idx long, n long, digest string"), "superblocks"))
    return out


def with_proofs(nodes: DataFrame, above: DataFrame, fanout: int, levels: int) -> DataFrame:
    """nodes (grp, idx, n, digest) with `lefts`, `rights` of their proofs: a bucket's own and then those of its root.

    above: the bucket roots with the same columns, as one row a bucket; it meets its nodes in one group of bounded size.
    """

    def extend(below: pd.DataFrame, root: pd.DataFrame) -> pd.DataFrame:
        below = below.sort_values("idx")
        lefts, rights = list(root["lefts"].iloc[0]), list(root["rights"].iloc[0])
        tree = levels_above(below["digest"].tolist(), int(below["up"].iloc[0]), fanout)
        own = [siblings(tree, i, fanout) for i in range(len(below))]
        out = below[["grp", "idx", "n", "digest"]].copy()
        out["lefts"], out["rights"] = [a + lefts for a, _ in own], [b + rights for _, b in own]
        return out

    left = bucketed(nodes.select("grp", "idx", "n", "digest"), fanout, levels).groupBy("grp", "bucket")
    right = above.select("grp", F.col("idx").alias("bucket"), "lefts", "rights").groupBy("grp", "bucket")
    return left.cogroup(right).applyInPandas(extend, "grp string, idx long, n long, digest string, lefts array<string>, rights array<string>")


def proofs_of(tables: list[DataFrame], top: DataFrame, fanout: int, levels: int) -> DataFrame:
    """From the proofs of the last table's nodes (`top`) those of the table above the first; of the first, if there is no other."""
    for nodes in tables[-2:0:-1]:
        top = materialize(with_proofs(nodes, top, fanout, levels), "proofs")
    return top


def manifest(
    docs: DataFrame, *, fanout: int = 8, levels: int = 3, tampered_every: int = 3, id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text",
    value_cols: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
) -> DataFrame:
    """One row for each row of docs: doc_id, leaf, subroot (of its group), root, proof_sha256, folded_root, verified.

    A leaf is the digest of the framed values; a group's leaves ascend by id, and while there are several nodes every
    `fanout` consecutive ones (the last run may be shorter, even one) become their digest, up to the group's subroot; the
    subroots in the order of their groups (null first, bytewise) likewise give the root. proof_sha256 is the digest of
    all siblings from the leaf to the root, left to right. folded_root is computed from the leaf and these siblings; of the
    rows whose unsigned crc32 of the id (null: of the empty text) is divisible by `tampered_every` from a leaf whose text
    has its A-Z lower-cased, which shows unless there are none, or the text is null.

    Null ids come first; rows with one id, repeated ones too, are ordered by their leaves. Columns that aren't named are
    ignored; values of any length are hashed whole; an empty table gives an empty result. A group with one leaf has that
    as its subroot, as a single group's subroot is the root.
    """
    values = [docs[f"`{c}`"] for c in value_cols]
    changed = [lower_ascii(v) if c == text_col else v for v, c in zip(values, value_cols, strict=True)]
    group = docs[f"`{group_col}`"].cast("string").alias("grp")
    altered = F.when(remainder_of_id(docs[f"`{id_col}`"], tampered_every) == 0, leaf_digest(changed))
    digests = materialize(docs.select(group, docs[f"`{id_col}`"].alias("doc_id"), leaf_digest(values).alias("digest"), altered.alias("changed")), "digests")
    leaves = numbered(digests, "grp", [F.col("doc_id").asc_nulls_first(), F.col("digest")], "leaves")
    discard(digests)
    tables = reductions(leaves, fanout, levels)
    groups = numbered(tables[-1].select(F.lit("").alias("all"), "grp", "digest"), "all", [F.col("grp").asc_nulls_first()], "subroots")
    groups = groups.withColumnsRenamed({"grp": "own", "all": "grp"})
    upper = reductions(groups, fanout, levels)
    none = F.array().cast("array<string>")
    root = upper[-1].withColumns({"lefts": none, "rights": none})
    proofs = proofs_of([leaves, *upper], root, fanout, levels).select(F.col("idx").alias("at"), "lefts", "rights")
    placed = groups.select("grp", F.col("own").alias("lang"), F.col("idx").alias("at"), F.col("digest").alias("subroot"))
    roots = upper[-1].select(F.col("grp").alias("_all"), F.col("digest").alias("root"))
    named = placed.join(roots, F.col("grp") == F.col("_all")).join(proofs.withColumnRenamed("at", "_at"), F.col("at") == F.col("_at"))
    named = materialize(named.select("lang", "subroot", "root", "lefts", "rights"), "subroot-proofs")
    top = tables[-1].join(named, F.col("grp").eqNullSafe(F.col("lang"))).select("grp", "idx", "n", "digest", "lefts", "rights")
    above = proofs_of(tables, materialize(top, "group-proofs"), fanout, levels)

    def check(below: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        below = below.sort_values("idx")
        lefts, rights = list(above["lefts"].iloc[0]), list(above["rights"].iloc[0])
        tree = levels_above(below["digest"].tolist(), int(below["up"].iloc[0]), fanout)
        rows = []
        for i, (doc_id, leaf, changed) in enumerate(zip(below["doc_id"], below["digest"], below["changed"], strict=True)):
            left, right = siblings(tree, i, fanout)
            left, right = left + lefts, right + rights
            proof = joined_digest(*(x for pair in zip(left, right, strict=True) for x in pair))
            rows.append((doc_id, leaf, proof, fold(changed or leaf, left, right)))
        out = pd.DataFrame(rows, columns=["doc_id", "leaf", "proof_sha256", "folded_root"])
        out["subroot"], out["root"] = above["subroot"].iloc[0], above["root"].iloc[0]
        return out

    tops = named.select(F.col("lang").alias("_l"), "subroot", "root")
    right = above.join(tops, F.col("grp").eqNullSafe(F.col("_l"))).select("grp", F.col("idx").alias("bucket"), "lefts", "rights", "subroot", "root")
    left = bucketed(leaves, fanout, levels).select("grp", "bucket", "up", "idx", F.col("doc_id").cast("string").alias("doc_id"), "digest", "changed")
    out = left.groupBy("grp", "bucket").cogroup(right.groupBy("grp", "bucket")).applyInPandas(check, "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType)).withColumn("verified", F.col("folded_root") == F.col("root"))
