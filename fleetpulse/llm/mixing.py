"""Mixing sources to target weights by a min-cost flow over membership patterns.

A document may belong to several sources. Documents are added up by the set of sources they belong to (their pattern);
patterns send words to the sources' targets at a cost that rises with each repetition, so that no text is repeated
while another can serve. The flow is solved on the totals, of which there are at most `MAX_PATTERNS`; the documents
are chosen by a seeded hash: a pattern's whole passes first, then hash buckets up to the cut, then single documents of
the one bucket on the cut while they fit. The mix never sorts or gathers a source; a rerun chooses the same.

Null source: a source of its own, last in order. Null or empty text: size 0, taken 0. Very long texts: all their words
count; one that is larger than the room left is taken if that comes nearer to the target than leaving it. Repeated rows: taken alike, and
together on the cut. An empty table gives an empty mix. Extra columns are passed on by `mixed`, and unused otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.common import WORD, free_name, row_key, ship_package, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
SEED = 20240607
#: Totals solved on the driver, at most (tested: that many of twelve sources in a minute); more are refused, not dropped.
MAX_PATTERNS = 100_000
#: Documents in a hash bucket, about.
BUCKET_ROWS = 4096
_UNIT = 2**32
_CUT = T.StructType(
    [
        T.StructField("pattern", T.StringType()),
        T.StructField("passes", T.LongType()),
        T.StructField("rest", T.LongType()),
        T.StructField("buckets", T.LongType()),
    ]
)


@dataclass
class Plan:
    """What the flow decided. sources: name -> (size, target); cuts: one row per pattern; edge: keys taken on the cut."""

    sources: dict[str | None, tuple[int, float]]
    cuts: DataFrame
    edge: DataFrame
    most: int


def order_of(source: str | None) -> tuple:
    return (source is None, (source or "").encode("utf-8"))


def targets(sizes: dict[str | None, int], total: float, weights: Sequence[float], most: float) -> dict[str | None, float]:
    """Shares of a total by weights that repeat over the sources by code point, null last; none above `most` times its
    source, the excess shared again by weight."""
    names = sorted(sizes, key=order_of)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, free, rest = {}, set(names), float(total)
    while free:
        unit = rest / sum(weight[s] for s in names if s in free)
        full = [s for s in names if s in free and unit * weight[s] > most * sizes[s]]
        if not full:
            return out | {s: unit * weight[s] for s in free}
        for s in full:
            out[s] = float(most * sizes[s])
            rest -= out[s]
            free.discard(s)
        rest = max(rest, 0.0)
    return out


def route(patterns: Sequence[tuple[int, Sequence]], quotas: dict, most: int) -> list[int]:
    """Words to take from each pattern (size, sources): a largest flow to the quotas, of least cost, where the r-th pass
    over a text costs 2r - 1 a word.

    Only passes cost anything, so the paths of least cost are those of the first pass as long as there are any, then those
    of the second, and so on; a path never takes back what a pattern sends. All paths of one cost are found together, as a
    largest flow by blocking flows over shortest paths: a few rounds over the arcs for each pass, whatever their number.
    """
    number = {s: i for i, s in enumerate(quotas)}
    room = list(quotas.values())
    members = [[number[s] for s in sources] for _, sources in patterns]
    through = [dict.fromkeys(m, 0) for m in members]  # what each pattern sends to each source
    back: list[dict[int, None]] = [{} for _ in room]  # patterns that send something to a source
    sent = [0] * len(patterns)
    for turn in range(most):
        left = [size for size, _ in patterns]
        while True:
            # Layers: patterns with words left, sources they reach, patterns whose words those could give up, and so on.
            layer_p, layer_s = [-1] * len(patterns), [-1] * len(room)
            front = [p for p, words in enumerate(left) if words]
            for p in front:
                layer_p[p] = 0
            depth, last = 0, False
            while front and not last:
                reached = []
                for p in front:
                    for s in members[p]:
                        if layer_s[s] < 0:
                            layer_s[s] = depth
                            reached.append(s)
                last = any(room[s] for s in reached)
                front = []
                if not last:
                    depth += 1
                    for s in reached:
                        for p in back[s]:
                            if layer_p[p] < 0:
                                layer_p[p] = depth
                                front.append(p)
            if not last:
                break
            _block_flow(left, room, members, through, back, layer_p, layer_s, depth)
        sent = [a + size - rest for a, (size, _), rest in zip(sent, patterns, left)]
    return sent


def _block_flow(left, room, members, through, back, layer_p, layer_s, depth) -> None:
    """Sends words along paths of pattern, source, pattern, ..., source through the layers until each is blocked."""
    next_s = [0] * len(members)
    givers: dict[int, list[int]] = {}
    next_p: dict[int, int] = {}
    for start in range(len(left)):
        if layer_p[start] != 0 or not left[start]:
            continue
        path = [start]  # alternately patterns and sources
        while path and left[start]:
            if len(path) % 2:
                p = path[-1]
                step = next((i for i in range(next_s[p], len(members[p])) if layer_s[members[p][i]] == layer_p[p]), None)
                if step is None:
                    next_s[p] = len(members[p])
                    path.pop()
                    if path:
                        next_p[path[-1]] += 1
                    continue
                next_s[p] = step
                path.append(members[p][step])
                continue
            s = path[-1]
            if layer_s[s] == depth:
                amount = min(left[start], room[s], *[through[path[i]][path[i - 1]] for i in range(2, len(path), 2)])
                if amount:
                    left[start] -= amount
                    room[s] -= amount
                    for i in range(0, len(path), 2):
                        through[path[i]][path[i + 1]] += amount
                        back[path[i + 1]][path[i]] = None
                        if i:
                            through[path[i]][path[i - 1]] -= amount
                    # On from the first place that is exhausted.
                    cut = next((i for i in range(2, len(path), 2) if not through[path[i]][path[i - 1]]), None)
                    if cut is not None:
                        next_p[path[cut - 1]] += 1
                        path = path[:cut]
                        continue
                    if room[s]:
                        continue
                path.pop()
                next_s[path[-1]] += 1
                continue
            if s not in givers:
                givers[s] = [p for p in back[s] if layer_p[p] == layer_s[s] + 1 and through[p][s]]
                next_p[s] = 0
            while next_p[s] < len(givers[s]) and not through[givers[s][next_p[s]]][s]:
                next_p[s] += 1
            if next_p[s] < len(givers[s]):
                path.append(givers[s][next_p[s]])
            else:
                path.pop()
                next_s[path[-1]] += 1
    for s, held in enumerate(back):
        for p in [p for p in held if not through[p][s]]:
            del held[p]


def pattern_of(memberships: Column) -> Column:
    """The set of sources of a document, as text."""
    return F.to_json(F.array_sort(F.array_distinct(memberships)))


def _place(buckets: Column) -> Column:
    """The hash bucket of a row, of the number of buckets that its pattern has."""
    return F.floor(F.col("_u") * buckets / F.lit(_UNIT))


def sized(documents: DataFrame, memberships: Column, seed: int) -> DataFrame:
    """Key, pattern, size and hash of each document."""
    return documents.select(
        row_key().alias("_key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        pattern_of(memberships).alias("pattern"),
        F.array_sort(F.array_distinct(memberships)).alias("sources"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ).withColumn("_u", F.pmod(F.xxhash64(F.lit(seed), "_key"), F.lit(_UNIT)))


def plan(
    rows: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: int = MAX_REPEATS,
) -> Plan:
    """Targets, flow and cuts for the documents that `sized` describes."""
    spark = rows.sparkSession
    ship_package(spark)
    totals = rows.groupBy("pattern").agg(F.first("sources").alias("sources"), F.sum("size").alias("size"), F.count("*").alias("rows"))
    found = totals.orderBy("pattern").limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} sets of sources; merge sources first")
    sizes: dict[str | None, int] = {}
    for p in found:
        for s in p["sources"]:
            sizes[s] = sizes.get(s, 0) + p["size"]
    goal = targets(sizes, share * sum(p["size"] for p in found), weights, most) if sizes else {}
    order = sorted(goal, key=order_of)
    sent = route([(p["size"], p["sources"]) for p in found], {s: round(goal[s]) for s in order}, most)
    cuts = []
    for p, flow in zip(found, sent):
        passes, rest = divmod(flow, p["size"]) if p["size"] else (1, 0)
        cuts.append((p["pattern"], passes, rest, 1 << max(0, math.ceil(math.log2(max(p["rows"], 1) / BUCKET_ROWS)))))
    cut = spark.createDataFrame(cuts, _CUT)
    placed = rows.join(F.broadcast(cut), "pattern").withColumn("bucket", _place(F.col("buckets")))
    sums = placed.groupBy("pattern", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    upto = F.sum("words").over(Window.partitionBy("pattern").orderBy("bucket"))
    on_cut = (
        sums.withColumn("before", upto - F.col("words"))
        .where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")))
        .select("pattern", F.col("bucket").alias("cut"), (F.col("rest") - F.col("before")).alias("room"))
    )
    where = {r["pattern"]: (r["cut"], r["room"]) for r in on_cut.collect()}
    rows_cut = [(*c, *where.get(c[0], (0, 0))) for c in cuts]
    schema = T.StructType([*_CUT.fields, T.StructField("cut", T.LongType()), T.StructField("room", T.LongType())])
    cut = spark.createDataFrame(rows_cut, schema)
    edge = (
        rows.join(F.broadcast(cut), "pattern")
        .where(_place(F.col("buckets")) == F.col("cut"))
        .groupBy("pattern", "_key", "_u", "room")
        .agg(F.sum("size").alias("size"))
        .groupBy("pattern")
        .applyInPandas(_fit, "pattern string, _d long, _h long")
    )
    return Plan({s: (sizes[s], goal[s]) for s in order}, cut, edge, most)


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket, the documents that fit in seeded order, and then the one that comes nearest to the room left."""
    rows = rows.assign(d=[k["d"] for k in rows["_key"]], h=[k["h"] for k in rows["_key"]]).sort_values(["_u", "d", "h"])
    room, taken = int(rows["room"].iloc[0]), []
    for size in rows["size"]:
        taken.append(size <= room)
        room -= size if taken[-1] else 0
    rows["taken"] = taken
    left = rows[~rows["taken"]]
    if len(left):
        nearest = (left["size"] - room).abs().idxmin()
        if abs(left.loc[nearest, "size"] - room) < room:
            rows.loc[nearest, "taken"] = True
    out = rows[rows["taken"]]
    return pd.DataFrame({"pattern": out["pattern"], "_d": out["d"], "_h": out["h"]})


def copies(rows: DataFrame, decided: Plan) -> DataFrame:
    """The rows, which have _key, pattern and _u, with how often the mix takes each, in the column _copies.

    Only rows of the buckets on the cuts are shuffled.
    """
    names = rows.columns
    placed = rows.join(F.broadcast(decided.cuts.select("pattern", "passes", "buckets", "cut")), "pattern").withColumn(
        "_bucket", _place(F.col("buckets"))
    )
    off = placed.where("_bucket <> cut").withColumn("_copies", F.col("passes") + (F.col("_bucket") < F.col("cut")).cast("long"))
    chosen = decided.edge.select("pattern", F.struct(F.col("_d").alias("d"), F.col("_h").alias("h")).alias("_key"), F.lit(1).alias("_one"))
    on = (
        placed.where("_bucket = cut")
        .join(chosen, ["pattern", "_key"], "left")
        .withColumn("_copies", F.col("passes") + F.coalesce(F.col("_one"), F.lit(0)))
    )
    both = off.select(*names, "_copies").unionByName(on.select(*names, "_copies"))
    # Documents without words add nothing to any cut, and so may lie on either side of it.
    return both.withColumn("_copies", F.least("_copies", F.lit(decided.most).cast("long")))


def mix(documents: DataFrame, memberships: Column | None = None, seed: int = SEED, **options) -> tuple[DataFrame, Plan]:
    """One row per document (doc_id, pattern, sources, size, taken), and the plan with each source's size and target."""
    memberships = F.array("source") if memberships is None else memberships
    rows = stored(sized(documents, memberships, seed), "mix-sizes")
    decided = plan(rows, **options)
    out = copies(rows, decided).select(
        "doc_id", "pattern", "sources", "size", (F.col("size") * F.col("_copies")).alias("taken")
    )
    return out, decided


def mixed(documents: DataFrame, memberships: Column | None = None, seed: int = SEED, **options) -> DataFrame:
    """The mix itself: the documents with all their columns, each as often as the mix takes it."""
    memberships = F.array("source") if memberships is None else memberships
    decided = plan(stored(sized(documents, memberships, seed), "mix-sizes"), **options)
    whole = free_name(documents, "row")
    rows = documents.select(
        F.struct("*").alias(whole), row_key().alias("_key"), pattern_of(memberships).alias("pattern")
    ).withColumn("_u", F.pmod(F.xxhash64(F.lit(seed), "_key"), F.lit(_UNIT)))
    taken = copies(rows, decided).where("_copies > 0")
    return taken.select(F.explode(F.array_repeat(whole, F.col("_copies").cast("int"))).alias(whole)).select(f"{whole}.*")
