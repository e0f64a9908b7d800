"""Merkle manifest of a dataset: a tree of hashes per language, a tree over the languages, and a proof for every row.

A leaf is the hash of a row's fields. In each language the leaves stand in order of doc_id; FANOUT nodes in a row have a
parent, their joint hash, level by level until one node, the language's subroot, is left. The subroots, in order of
language, make a tree of the same kind, whose top is the root.

A level is built from its nodes by equal joins with computed sibling indices: the node in slot zero of a run, index i,
is joined with the nodes of index i + 1, i + 2 and so on, each known by the run and its slot. Each node is shuffled once
and the slot-zero row, which then holds its run, emits the parent. Proofs go down the same runs: what a node needs
besides its own hash is its siblings and what its parent needs. Runs are at most FANOUT rows, keys are (language, run), so
a language of any size spreads over all tasks. Indices come from ranges of equal depth. Every level is written once.

H is lower-case hex SHA-256 of text in UTF-8. A field is `-` if null, else its length in bytes, a colon and the value; a
leaf is H of the fields doc_id, source, lang, n_chars and text one after the other, and so depends on every byte of each.
Null doc_id: before all others in its language. Null lang: a language of its own, before all others. Ties of doc_id: in
order of the leaf; equal rows have equal leaves in places of their own. Empty text: a field of length zero. Very long
texts are hashed whole, a row at a time. An empty table has no rows and no root. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import stored
from fleetpulse.operators.ordered import position_in_order

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"
PROVED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(*parts: Column) -> Column:
    """H of texts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf(**changed: Column) -> Column:
    """The leaf of a row, with other values for some of its fields."""

    def field(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(*map(field, FIELDS))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path (the siblings of each level, to the left and to the right) lead to."""
    return F.aggregate(path, start, lambda node, level: digest(level["left"], node, level["right"]))


def proof_digest(path: Column) -> Column:
    """H of all siblings of a path, level by level from the leaf up, left to right."""
    return digest(F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), ""))


def _runs(nodes: DataFrame, fanout: int) -> DataFrame:
    """(branch, run, nodes, parent, top): each run of nodes (branch, idx, node), put together on its slot-zero row. `top`
    marks a node without siblings that is the only one of its branch."""
    placed = nodes.select(
        "branch", F.expr(f"idx div {fanout}").alias("run"), F.expr(f"idx % {fanout}").alias("slot"), "node"
    )
    slots = [placed.where(F.col("slot") == s).select("branch", "run", F.col("node").alias(f"s{s}")) for s in range(fanout)]
    runs = slots[0]
    for sibling in slots[1:]:
        runs = runs.join(sibling, ["branch", "run"], "left")
    held = runs.select("branch", "run", F.array_compact(F.array(*[f"s{s}" for s in range(fanout)])).alias("nodes"))
    parent = digest(F.array_join(F.transform("nodes", lambda node: node["hash"]), ""))
    return held.withColumns({"parent": parent, "top": (F.col("run") == 0) & (F.size("nodes") == 1)})


def _climb(leaves: DataFrame, fanout: int) -> list[DataFrame]:
    """The written runs of every level, from the leaves (branch, idx, node) up."""
    last = leaves.agg(F.max("idx")).first()[0]
    levels, nodes = [], leaves
    while True:
        runs = stored(_runs(nodes, fanout), "merkle")
        levels.append(runs)
        if not last:
            return levels
        last //= fanout
        nodes = runs.where(~F.col("top")).select(
            "branch", F.col("run").alias("idx"), F.struct(F.col("parent").alias("hash")).alias("node")
        )


def _tops(levels: list[DataFrame]) -> DataFrame:
    """(branch, hash) of the node that is left of each branch."""
    tops = [runs.where("top").select("branch", F.col("nodes")[0]["hash"].alias("hash")) for runs in levels]
    found = tops[0]
    for other in tops[1:]:
        found = found.unionByName(other)
    return found


def _paths(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """(branch, idx, node, path, kept) of every leaf; `above` has branch, path and kept of the node left of each branch."""
    below = None
    for runs in reversed(levels):
        held = runs.where("top").join(above, "branch").select("branch", "run", "nodes", "path", "kept", F.lit(False).alias("joined"))
        if below is not None:
            parents = below.select("branch", F.col("idx").alias("run"), "path", "kept")
            inner = runs.where(~F.col("top")).join(parents, ["branch", "run"])
            held = held.unionByName(inner.select("branch", "run", "nodes", "path", "kept", F.lit(True).alias("joined")))
        # A node without siblings and parent adds no level to its path.
        hashes = F.transform("nodes", lambda node: node["hash"])
        own = F.struct(
            F.array_join(F.slice(hashes, F.lit(1), F.col("slot")), "").alias("left"),
            F.array_join(F.slice(hashes, F.col("slot") + 2, F.size("nodes")), "").alias("right"),
        )
        path = F.when(F.col("joined"), F.concat(F.array(own), F.col("path"))).otherwise(F.col("path"))
        below = held.select("*", F.posexplode("nodes").alias("slot", "node")).select(
            "branch", (F.col("run") * FANOUT + F.col("slot")).alias("idx"), "node", path.alias("path"), "kept"
        )
    return below


def prove(leaves: DataFrame) -> DataFrame:
    """leaf, subroot, root and path of every leaf (lang, doc_id, leaf); all columns but lang and leaf are passed on, in the
    struct `row`."""
    spark = leaves.sparkSession
    # Languages as text in their order: null before all others.
    branch = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    others = F.struct(*[c for c in leaves.columns if c not in ("lang", "leaf")]).alias("row")
    rows = stored(leaves.select(branch.alias("branch"), "doc_id", "leaf", others), "leaves")
    placed = position_in_order(rows, name="idx", keys=["branch"], order=["doc_id", "leaf"])
    node = F.struct(F.col("leaf").alias("hash"), "row").alias("node")
    levels = _climb(stored(placed.select("branch", "idx", node), "leaves"), FANOUT)
    subroots = _tops(levels).select(F.lit("").alias("all"), "branch", "hash")
    ranked = position_in_order(subroots, name="idx", keys=["all"], order=["branch"])
    over = _climb(
        ranked.select(F.col("all").alias("branch"), "idx", F.struct("hash", F.col("branch").alias("lang")).alias("node")), FANOUT
    )
    root = _tops(over).first()
    end = spark.range(1).select(
        F.lit("").alias("branch"), F.expr(f"cast(array() as {PATH})").alias("path"), F.lit("").alias("kept")
    )
    above = stored(
        _paths(over, end).select(F.col("node.lang").alias("branch"), "path", F.col("node.hash").alias("kept")), "subroots"
    )
    return _paths(levels, above).select(
        F.col("node.row").alias("row"),
        F.col("node.hash").alias("leaf"),
        F.col("kept").alias("subroot"),
        F.lit(root["hash"] if root else None).cast("string").alias("root"),
        "path",
    )


def lower_ascii(text: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def verify(documents: DataFrame, *, tampered: Column, text: Column) -> DataFrame:
    """PROVED for every document: the manifest as it is, and the root that its own leaf, or where `tampered` holds the
    leaf with another text, leads to by the siblings as they were."""
    leaves = documents.select(
        "doc_id",
        "lang",
        leaf().alias("leaf"),
        F.when(F.coalesce(tampered, F.lit(False)), leaf(text=text)).alias("changed"),
    )
    proved = prove(leaves).withColumn("folded_root", fold(F.coalesce("row.changed", "leaf"), F.col("path")))
    return proved.select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
