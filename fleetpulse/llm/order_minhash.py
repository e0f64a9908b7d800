"""Near-duplicate groups by Order MinHash, verified by banded alignment.

A text is the sequence of its runs of five words (k-mers), each labelled with how many equal ones came before, so that
no label repeats. A sketch takes the two labels of least hash under one permutation and keeps their order in the text:
texts agree in it only if they share both labels in the same order. Two neighbouring sketches form a band; texts that
agree in a band are candidates, unless they agree in too few sketches altogether.

Similarity is the number of k-mers aligned in order, divided by all k-mers of both texts less those: the Jaccard
similarity of five-word shingles where order agrees. Documents of similarity `threshold` or more are linked and a class
is a connected component of links.

A bucket's pairs are not listed. Equal texts are one node. Each bucket has a hub, the member with the fullest buckets,
which every member is aligned with; members linked so are one. Only buckets that still hold several components are
looked at again: a pair of different components is aligned if its sketches agree enough and if the k-mers that both share
with the hub, and those they share outside it, reach the threshold as sets. No pair that shares a band and could reach the
threshold is left out, and hardly any other is listed. A large open bucket, such as all pages with one passage in common,
is first split by two further sketches: the sketches besides a band's two lie in five groups, so a pair that agrees in
MIN_SHARED sketches agrees in two of one group, and meets in the part of the bucket that holds the texts alike in these.
A bucket whose parts would have more pairs than itself, as its texts are alike in most sketches, stays whole. What is
large then is taken in blocks.

Null or empty text: a class of its own. Texts of fewer than five words: one k-mer, so equal texts only. Null doc_id:
before all others; equal ids are told apart by their text; rows that agree in both are one node. Very long texts are
sketched whole. An empty table gives no rows. Extra columns are passed on by `keep_one`, and unused otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import row_key, ship_package, slices, stored
from fleetpulse.llm.components import components
from fleetpulse.llm.line_dedup import increasing
from fleetpulse.llm.text import U64, Batch, _power, mix, occurrence, windows

WORDS = 5
THRESHOLD = 0.8
SKETCHES = 32
#: Sketches of 32 that candidates share at least: texts at the threshold share 20 on average, with a deviation of 2.7.
MIN_SHARED = 8
#: A member is aligned with its hub if neither has more than four times the k-mers of the other.
HUB_LENGTHS = 0.25
#: Members of a block of a large bucket, or part of one.
BLOCK = 1024
#: Pairs of sketches that split a large bucket, by their distance from the band's first: those of five groups of six. Of
#: MIN_SHARED agreeing sketches six are no band's, and two of them in one group.
SPLITS = [(x, y) for g in range(2, SKETCHES, 6) for x in range(g, g + 6) for y in range(x + 1, g + 6)]
_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=U64) * U64(0xA0761D6478BD642F)) | U64(1)
_MOST = U64(2**64 - 1)


def labels_of(batch: Batch) -> tuple[np.ndarray, np.ndarray]:
    """The labelled k-mers of each text, and the bounds of each text among them."""
    hashes = batch.word_hashes()
    grams, at = windows(hashes, batch.word_row, WORDS)
    rows = batch.word_row[at]
    counts = np.diff(batch.word_bounds)
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    if len(short):
        whole = mix(_sequence(batch, hashes)[0][short] + U64(1))
        grams, rows = np.concatenate((grams, whole)), np.concatenate((rows, short))
        order = np.argsort(rows, kind="stable")
        grams, rows = grams[order], rows[order]
    ids = mix(grams + occurrence(grams, rows).astype(U64) * U64(0xE7037ED1A0B428DB))
    return ids, np.searchsorted(rows, np.arange(batch.rows + 1))


def _sequence(batch: Batch, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for the sequence of words of each text."""
    out = []
    start, end = batch.word_bounds[:-1], batch.word_bounds[1:]
    for h in (hashes, mix(hashes ^ U64(0x5851F42D4C957F2D))):
        sums = np.zeros(len(h) + 1, U64)
        np.cumsum(h * _power("up", len(h)), out=sums[1:])
        out.append(mix((sums[end] - sums[start]) * _power("down", len(h) + 1)[start] + (end - start).astype(U64)))
    return out[0], out[1]


def sketches_of(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of sketches for each text with two labels or more, zeros otherwise."""
    sizes = np.diff(bounds)
    out = np.zeros((len(sizes), SKETCHES), np.int64)
    rows = np.flatnonzero(sizes > 1)
    if not len(rows):
        return out
    use = np.repeat(sizes > 1, sizes)
    ids, sizes = ids[use], sizes[rows]
    starts = np.cumsum(sizes) - sizes
    for j, seed in enumerate(_SEEDS):
        h = (ids ^ (seed >> U64(7))) * seed
        h ^= h >> U64(32)
        first = np.minimum.reduceat(h, starts)
        at = np.flatnonzero(h == np.repeat(first, sizes))
        at = at[np.searchsorted(at, starts)]  # hashes are distinct but for a freak
        h[at] = _MOST
        second = np.minimum.reduceat(h, starts)
        then = np.flatnonzero(h == np.repeat(second, sizes))
        then = then[np.searchsorted(then, starts)]
        pair = mix(ids[np.minimum(at, then)] * U64(0x9FB21C651E98DF25) + ids[np.maximum(at, then)] + U64(j))
        out[rows, j] = pair.view(np.int64)
    return out


def _sketching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for a, b in slices(rows["text"]):
            batch = Batch(rows["text"].slice(a, b - a))
            ids, bounds = labels_of(batch)
            one, two = _sequence(batch, batch.word_hashes())
            found = sketches_of(ids, bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    rows["d"].slice(a, b - a),
                    rows["h"].slice(a, b - a),
                    pa.array(one.view(np.int64)),
                    pa.array(two.view(np.int64)),
                    pa.array(np.diff(bounds).astype(np.int32)),
                    pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), SKETCHES).cast(pa.list_(pa.int64())),
                ],
                ["d", "h", "one", "two", "n", "sketch"],
            )


def _labelling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for a, b in slices(rows["text"]):
            ids, bounds = labels_of(Batch(rows["text"].slice(a, b - a)))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int64)))
            yield pa.RecordBatch.from_arrays([rows["d"].slice(a, b - a), rows["h"].slice(a, b - a), lists], ["d", "h", "ids"])


def aligned(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[bool, np.ndarray, np.ndarray]:
    """Whether two sequences of labels reach the threshold, and the places of all labels they share, in a and in b.

    An alignment of enough labels leaves at most so many unmatched, and so stays within a band of that width.
    """
    _, at, to = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    needed = threshold / (1 + threshold) * (len(a) + len(b)) - 1e-9
    order = np.argsort(at)
    at, to = at[order], to[order]
    if len(at) < needed:
        return False, at, to
    inside = np.abs(at - to) <= len(a) + len(b) - 2 * needed + 1
    path = to[inside]
    kept = len(path) if (np.diff(path) > 0).all() else len(increasing(path.tolist()))
    return kept >= needed, at, to


def _aligning(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            left, right = rows["a_ids"], rows["b_ids"]
            la, lb = left.flatten().to_numpy(), right.flatten().to_numpy()
            oa, ob = left.offsets.to_numpy() - left.offsets[0].as_py(), right.offsets.to_numpy() - right.offsets[0].as_py()
            linked, shared, outside = [], [], []
            for i in range(rows.num_rows):
                a, b = la[oa[i] : oa[i + 1]], lb[ob[i] : ob[i + 1]]
                yes, at, to = aligned(a, b, threshold)
                bits = np.zeros(len(a), bool)
                bits[at] = True
                linked.append(yes)
                shared.append(np.packbits(bits).tobytes())
                outside.append(np.sort(np.delete(b, to).astype(np.int32)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [rows["a"], rows["b"], pa.array(linked), pa.array(shared, pa.binary()), pa.array(outside, pa.binary())],
                ["a", "b", "linked", "shared", "outside"],
            )

    return run


_NODE = "struct<d:bigint,h:bigint>"


def align(pairs: DataFrame, sequences: DataFrame, threshold: float) -> DataFrame:
    """For pairs of the structs a and b: linked, the places in a that b shares as bits, and the labels of b outside a (32
    bits of each, in order)."""
    rows = (
        pairs.select("a", "b")
        .join(sequences.select(F.col("node").alias("b"), F.col("ids").alias("b_ids")), "b")
        .join(sequences.select(F.col("node").alias("a"), F.col("ids").alias("a_ids")), "a")
        .select("a", "b", "a_ids", "b_ids")
    )
    return rows.mapInArrow(_aligning(threshold), f"a {_NODE}, b {_NODE}, linked boolean, shared binary, outside binary")


def _length_fits(a: str, b: str, threshold: float) -> Column:
    return F.least(a, b) >= F.lit(threshold - 1e-9) * F.greatest(a, b)


def _crossing(threshold: float):
    """Pairs of different components within a block, or between two, that may reach the threshold; each pair only in the
    first band it shares."""

    def pairs(members: dict, band: int, split: int, across: bool) -> Iterator[tuple[int, int]]:
        size, label, side = (np.array(members[c]) for c in ("n", "label", "side"))
        sketch = np.array(members["sketch"])
        known = np.array([x is not None for x in members["shared"]])
        width = max((len(x) for x in members["shared"] if x is not None), default=0)
        bits = np.zeros((len(size), width), np.uint8)
        for k in np.flatnonzero(known):
            bits[k, : len(members["shared"][k])] = np.frombuffer(members["shared"][k], np.uint8)
        bits = np.unpackbits(bits, axis=1).astype(np.float32)
        outside = [np.frombuffer(x or b"", np.int32) for x in members["outside"]]
        extra = np.array([len(x) for x in outside])
        for k in range(len(size) - 1):
            later = np.arange(k + 1, len(size))
            later = later[(label[later] != label[k]) & ((side[later] != side[k]) | (not across))]
            later = later[np.minimum(size[later], size[k]) >= (threshold - 1e-9) * np.maximum(size[later], size[k])]
            if not len(later):
                continue
            same = sketch[later] == sketch[k]
            first = (same & np.roll(same, -1, axis=1)).argmax(1)
            once = (same.sum(1) >= MIN_SHARED) & (first == band)
            if split >= 0:
                # In the part of the first splitting pair of sketches that both agree in.
                both = [same[:, [(band + s[i]) % SKETCHES for s in SPLITS]] for i in (0, 1)]
                once &= (both[0] & both[1]).argmax(1) == split
            later = later[once]
            needed = threshold / (1 + threshold) * (size[later] + size[k]) - 1e-6
            through_hub = bits[later] @ bits[k]
            unknown = ~known[later] | ~known[k]
            maybe = unknown | (through_hub + np.minimum(extra[later], extra[k]) >= needed)
            for x, most, least, is_open in zip(later[maybe], through_hub[maybe], needed[maybe], unknown[maybe]):
                if is_open or most + np.intersect1d(outside[k], outside[x]).size >= least:
                    yield k, x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            a, b = [], []
            bands, splits, lows, highs = (rows[c].to_pylist() for c in ("j", "split", "low", "high"))
            for i in range(rows.num_rows):
                found = rows["members"][i].values
                members = {c: found.field(c).to_pylist() for c in ("n", "sketch", "shared", "outside", "side")}
                nodes = found.field("node").to_pylist()
                numbers = {}
                members["label"] = [numbers.setdefault((x["d"], x["h"]), len(numbers)) for x in found.field("label").to_pylist()]
                for x, y in pairs(members, bands[i], splits[i], lows[i] != highs[i]):
                    u, v = sorted((nodes[x], nodes[y]), key=lambda n: (n["d"], n["h"]))
                    a.append(u)
                    b.append(v)
            node = pa.struct([("d", pa.int64()), ("h", pa.int64())])
            yield pa.RecordBatch.from_arrays([pa.array(a, node), pa.array(b, node)], ["a", "b"])

    return run


def _parts(members: DataFrame) -> DataFrame:
    """Members of open buckets with the part they are in: the whole bucket (split -1), or, of a large one that has fewer
    pairs so, one part for each splitting pair of sketches that has several components. `size` becomes the part's."""
    whole = members.withColumns({"split": F.lit(-1), "value": F.lit(0).cast("long")})
    large = members.where(F.col("size") > BLOCK)
    # Few columns first: most parts hold one text, and need no more.
    value = lambda s: F.get("sketch", (F.col("j") + s) % SKETCHES)
    values = F.array(*[F.xxhash64(value(x), value(y)) for x, y in SPLITS])
    placed = large.select("band", "size", "node", "label", F.posexplode(values).alias("split", "value"))
    parts = (
        placed.groupBy("band", "split", "value")
        .agg(F.min("label").alias("from_label"), F.max("label").alias("to_label"), F.count("*").alias("held"), F.first("size").alias("size"))
        .where("from_label <> to_label")
    )
    pairs = F.col("held").cast("double") * F.col("held")
    divided = parts.groupBy("band").agg((F.sum(pairs) < F.first("size").cast("double") * F.first("size")).alias("divided"))
    # A large bucket without any part of several components has no pair to look at.
    kept = whole.join(divided, "band", "left").where((F.col("size") <= BLOCK) | ~F.coalesce("divided", F.lit(True)))
    wanted = parts.join(divided.where("divided"), "band").select("band", "split", "value", "held")
    meeting = placed.select("band", "node", "split", "value").join(wanted, ["band", "split", "value"])
    split = large.join(meeting, ["band", "node"]).withColumn("size", F.col("held"))
    return kept.select(*whole.columns).unionByName(split.select(*whole.columns))


def classes(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: its key (node) and that of its class's first document (first)."""
    ship_package(documents.sparkSession)
    narrow = documents.select(row_key().alias("_key"), F.col("text").cast("string").alias("text"))
    narrow = narrow.select("_key.d", "_key.h", "text")
    found = stored(
        narrow.mapInArrow(_sketching, "d long, h long, one long, two long, n int, sketch array<long>"), "sketches"
    ).withColumn("node", F.struct("d", "h"))
    texts = found.where("n > 0").groupBy("one", "two").agg(
        F.min("node").alias("node"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    nodes = stored(texts, "texts")
    sketched = nodes.where("n > 1")
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(SKETCHES - 1)),
        lambda j: F.xxhash64(j, F.get("sketch", j), F.get("sketch", (j + 1) % SKETCHES)),
    )
    rows = sketched.select("node", "n", F.posexplode(bands).alias("j", "band"))
    full = rows.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(rows.join(full, "band"), "members")
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = (
        members.join(weight, "node")
        .groupBy("band")
        .agg(F.max(F.struct("weight", "node", "n")).alias("hub"))
        .select("band", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"))
    )
    members = stored(members.join(hubs, "band"), "members")
    sketch = nodes.select("node", "sketch")
    pairs = (
        # A hub is aligned with members of another length, too: what they share with it tells members apart.
        members.where((F.col("hub") != F.col("node")) & _length_fits("n", "hub_n", HUB_LENGTHS))
        .select(F.col("hub").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    # A member that fails here may still be like another member: all members' labels are kept at hand.
    wanted = members.select("node").distinct()
    texts_wanted = (
        narrow.withColumn("node", F.struct("d", "h"))
        .join(wanted, "node", "left_semi")
        .groupBy("d", "h")
        .agg(F.first("text").alias("text"))
    )
    sequences = stored(texts_wanted.mapInArrow(_labelling, "d long, h long, ids array<long>"), "labels").select(
        F.struct("d", "h").alias("node"), "ids"
    )
    star = stored(align(pairs, sequences, threshold), "star")
    links = star.where("linked").select("a", "b")
    labels = components(links)
    # Buckets that still hold several components.
    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_buckets = (
        labelled.groupBy("band")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low <> high")
        .select("band")
    )
    open_members = (
        labelled.join(open_buckets, "band")
        .join(sketch, "node")
        .join(star.select(F.col("a").alias("hub"), F.col("b").alias("node"), "shared", "outside"), ["hub", "node"], "left")
    )
    blocked = _parts(open_members).withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    blocks = (
        blocked.select("*", other)
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .groupBy("band", "j", "split", "value", "low", "high")
        .agg(
            F.collect_list(
                F.struct("node", "label", "n", "sketch", "shared", "outside", F.col("block").alias("side"))
            ).alias("members")
        )
        .where(F.size("members") > 1)
    )
    crossing = blocks.mapInArrow(_crossing(threshold), f"a {_NODE}, b {_NODE}")
    more = stored(align(crossing, sequences, threshold).where("linked").select("a", "b"), "cross")
    labels = components(links.unionByName(more))
    first = nodes.join(labels, "node", "left").select("one", "two", F.coalesce("label", "node").alias("first"))
    worded = found.where("n > 0").join(first, ["one", "two"]).select("node", "first")
    return worded.unionByName(found.where("n = 0").select("node", F.col("node").alias("first")))


def class_ids(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (the first document's id) and whether the document is that first one."""
    null = F.lit(-(2**63))
    return classes(documents, threshold).select(
        F.nullif(F.col("node.d"), null).alias("doc_id"),
        F.nullif(F.col("first.d"), null).alias("class_id"),
        (F.col("node") == F.col("first")).alias("is_first"),
    )


def keep_one(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The first document of each class, with all its columns; of repeated rows one."""
    found = stored(classes(documents, threshold), "classes")
    # What becomes of a row: others than the first go, and of rows that repeat the first one stays.
    fate = found.groupBy(F.col("node").alias("_key")).agg(
        F.when(F.first(F.col("node") != F.col("first")), "goes").when(F.count("*") > 1, "once").alias("fate")
    )
    rows = documents.select(F.struct("*").alias("whole"), row_key().alias("_key"))
    joined = rows.join(fate.where("fate is not null").hint("merge"), "_key", "left")
    once = joined.where("fate is null").select("whole", "_key")
    several = joined.where("fate = 'once'").select("whole", "_key").dropDuplicates(["_key"])
    return once.unionByName(several).select("whole.*")
