"""Decision trees for many subjects at once, grown level by level.

The training documents are read once a level, whatever the number of subjects:
values are turned into bin numbers once, then
every task counts in arrays, for every (subject, node, bucket, bin), the documents and
the positives, and one aggregate sums them.  Entries of a sparse vector are counted; documents without an
entry are what is missing from the node's total and belong to the bin of zero.
From the counts follow the entropy gains of all splits, and an arg-max picks the
best of each node.  All training documents count; the driver sees one row a node,
at most names * 2^depth.

Values are cut into at most ``bins`` bins a bucket, in the way of spark.ml:
between every two neighbouring values if there are few, otherwise near equal
shares.  Like there, the cuts come from a bounded number of documents
(SPLIT_ROWS, drawn by a hash of the id; all, when there are no more), so a
bucket with very many documents is no unbounded group.

A node is split if its best gain is positive.  Gains are compared to 12
decimals; ties go to the smaller bucket, then the smaller threshold.  A leaf
predicts the majority, 0 on a tie.  As growing is greedy, the tree of a lesser
depth is the deepest one cut off.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeworks.operators.lookup import BROADCAST_BYTES
from tomeworks.operators.vectors import sparse_entries
from tomeworks.staging import stage

BINS = 5
SPLIT_ROWS = 10_000
_GAIN_DIGITS = 12
_LIST_ENTRY_BYTES = 64
_CELL_BYTES = 128 << 20


@dataclass
class Node:
    """Documents and positives below a node; its split, if it has one.  Children of node i are 2i and 2i + 1, the root is 1."""

    n: int
    positives: float
    bucket: int | None = None
    threshold: float | None = None
    gain: float | None = None
    bin: int | None = None  # the last that goes left
    zero_bin: int | None = None

    @property
    def prediction(self) -> float:
        return 1.0 if self.positives > self.n - self.positives else 0.0

    @property
    def open(self) -> bool:
        return 0 < self.positives < self.n


@dataclass
class Trees:
    names: list[str]
    depth: int
    nodes: list[dict[int, Node]] = field(default_factory=list)

    def table(self, spark: SparkSession) -> DataFrame:
        """(subject, node, depth, n_docs, positives, prediction, bucket, threshold, gain); leaves have no split."""
        rows = [
            (name, i, i.bit_length() - 1, x.n, int(x.positives), x.prediction, x.bucket, x.threshold, x.gain)
            for name, nodes in zip(self.names, self.nodes)
            for i, x in sorted(nodes.items())
        ]
        return spark.createDataFrame(
            rows,
            "subject string, node int, depth int, n_docs bigint, positives bigint, prediction double,"
            " bucket int, threshold double, gain double",
        )


def thresholds(train: DataFrame, bins: int = BINS, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """(bucket, cuts ARRAY<DOUBLE>, zero_bin) of (doc_id, vec); buckets of one value only have none and are left out."""
    n = train.count()
    if n > split_rows:
        draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) * F.lit(float(n)) < F.lit(float(split_rows) * (1 << 30))
        train = stage(train.where(draw).select("doc_id", "vec"), "split-rows")
        n = train.count()
    counts = train.select(F.inline("vec")).groupBy("bucket", "w").agg(F.count("*").cast("double").alias("n"))
    # as many entries as documents were drawn, at most
    listed = counts.groupBy("bucket").agg(F.collect_list(F.struct("w", "n")).alias("values"))
    found = F.aggregate("values", F.lit(0.0), lambda total, x: total + x["n"])
    zero = F.array(F.struct(F.lit(0.0).alias("w"), (F.lit(float(n)) - found).alias("n")))
    values = F.array_sort(F.when(found < n, F.concat("values", zero)).otherwise(F.col("values")))
    ordered = listed.select("bucket", values.alias("values")).where(F.size("values") > 1)
    middle = lambda a, b: (a + b) / 2
    rest = F.slice("values", 2, F.size("values"))
    every = F.zip_with(F.slice("values", 1, F.size("values") - 1), rest, lambda a, b: middle(a["w"], b["w"]))
    step = float(n) / bins

    def walk(state: Column, x: Column) -> Column:
        """A cut where going on would lead further away from the next multiple of ``step``."""
        after = state["count"] + x["n"]
        cut = F.abs(state["count"] - state["target"]) < F.abs(after - state["target"])
        return F.struct(
            after.alias("count"),
            x["w"].alias("before"),
            F.when(cut, state["target"] + step).otherwise(state["target"]).alias("target"),
            F.when(cut, F.concat(state["cuts"], F.array(middle(state["before"], x["w"])))).otherwise(state["cuts"]).alias("cuts"),
        )

    first = F.get("values", F.lit(0))
    start = F.struct(
        first["n"].alias("count"),
        first["w"].alias("before"),
        F.lit(step).alias("target"),
        F.array().cast("array<double>").alias("cuts"),
    )
    strided = F.aggregate(rest, start, walk, lambda state: state["cuts"])
    cuts = F.when(F.size("values") <= bins, every).otherwise(strided)
    cut = ordered.select("bucket", cuts.alias("cuts")).where(F.size("cuts") > 0)
    return cut.withColumn("zero_bin", F.size(F.filter("cuts", lambda c: c < 0)))


def binned_rows(train: DataFrame, cuts: DataFrame, bins: int) -> DataFrame:
    """(doc_id, labels, entries ARRAY<STRUCT<bucket, bin>>) of the buckets that have cuts.

    With the cuts in every task a document is never taken apart; only cuts too many for that are joined.
    """
    if cuts.count() * (bins + 1) * _LIST_ENTRY_BYTES <= BROADCAST_BYTES:
        return _binned_in_rows(train, cuts)
    entries = train.select("doc_id", "labels", F.inline("vec")).join(cuts, "bucket")
    at = [F.coalesce((F.get("cuts", F.lit(i)) < F.col("w")).cast("int"), F.lit(0)) for i in range(bins)]
    above = sum(at[1:], at[0])
    found = entries.select("doc_id", "labels", "bucket", above.alias("bin"))
    return found.groupBy("doc_id").agg(
        F.first("labels").alias("labels"), F.collect_list(F.struct("bucket", "bin")).alias("entries")
    )


def _binned_in_rows(train: DataFrame, cuts: DataFrame) -> DataFrame:
    known = cuts.select("bucket", "cuts").orderBy("bucket").toArrow()  # at most one row a bucket
    values = known.column("cuts").to_pylist()
    table = np.full((len(values) + 1, max(map(len, values), default=1)), np.inf)  # the last is that of no bucket
    for i, some in enumerate(values):
        table[i, : len(some)] = some
    shared = train.sparkSession.sparkContext.broadcast((known.column("bucket").to_numpy(), table))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, limits = shared.value
        for batch in batches:
            row, bucket, value = sparse_entries(batch, "vec")
            at = np.searchsorted(buckets, bucket)
            cut = np.append(buckets, -1)[at] == bucket
            row, bucket, value, at = row[cut], bucket[cut], value[cut], at[cut]
            bins = (limits[at] < value[:, None]).sum(axis=1)
            entries = pa.StructArray.from_arrays([pa.array(bucket, pa.int32()), pa.array(bins, pa.int32())], ["bucket", "bin"])
            offsets = np.append(0, np.cumsum(np.bincount(row, minlength=len(batch))))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)
            columns = [batch.column("doc_id"), batch.column("labels"), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "labels", "entries"])

    kind = train.schema["doc_id"].dataType.simpleString()
    return train.select("doc_id", "labels", "vec").mapInArrow(
        binned, f"doc_id {kind}, labels array<double>, entries array<struct<bucket:int,bin:int>>"
    )


def _places(trees: Trees, depth: int, entries: tuple[np.ndarray, ...], n: int, by_bin: bool) -> np.ndarray:
    """For every subject and document the node at a depth, or the leaf above it, from the values or bins of the entries."""
    row, bucket, value = entries
    asked = np.array(sorted({x.bucket for nodes in trees.nodes for x in nodes.values() if x.bucket is not None}), np.int64)
    at = np.searchsorted(asked, bucket)
    hit = np.append(asked, -1)[at] == bucket
    values, there = np.zeros((len(asked), n)), np.zeros((len(asked), n), bool)
    values[at[hit], row[hit]], there[at[hit], row[hit]] = value[hit], True
    places = np.ones((len(trees.nodes), n), np.int32)
    for place, nodes in zip(places, trees.nodes):
        for i, node in sorted(nodes.items()):
            if node.bucket is None or i.bit_length() > depth:
                continue
            k = np.searchsorted(asked, node.bucket)
            if by_bin:
                right = np.where(there[k], values[k], node.zero_bin) > node.bin
            else:
                right = (values[k] > node.threshold) | np.isnan(values[k])  # NaN is larger than any number
            place[:] = np.where(place == i, 2 * i + right, place)
    return places


def _entropy(n: Column, positives: Column) -> Column:
    part = lambda x: F.when(x > 0, -(x / n) * F.log2(x / n)).otherwise(0.0)
    return part(positives) + part(n - positives)


def _level_histograms(binned: DataFrame, trees: Trees, depth: int, buckets: np.ndarray, bins: int) -> DataFrame:
    """(subject, node, bucket, n0, n1, ..., p0, p1, ...): documents and positives by bin over the open nodes of a depth.

    A task counts its documents in arrays, and exchanges one row for each node and bucket it has seen.  The arrays of
    some subjects at a time take at most _CELL_BYTES; the table is read once for each such part.
    """
    active = [[i for i, x in nodes.items() if x.open and i.bit_length() - 1 == depth] for nodes in trees.nodes]
    size = lambda s: len(active[s]) * max(1, len(buckets)) * bins * 16
    parts: list[list[int]] = []
    for s in (s for s, some in enumerate(active) if some):
        if not parts or sum(map(size, [*parts[-1], s])) > _CELL_BYTES:
            parts.append([])
        parts[-1].append(s)
    shared = binned.sparkSession.sparkContext.broadcast(buckets)
    names = ["subject", "node", "bucket", *[f"{c}{b}" for c in "np" for b in range(bins)]]
    schema = ", ".join(["subject int, node int, bucket int", *[f"{c} double" for c in names[3:]]])

    def counter(subjects: list[int]) -> Callable:
        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            width = len(known) * bins
            counts = {s: np.zeros((2, len(active[s]) * width)) for s in subjects}
            for batch in batches:
                if not len(batch):
                    continue
                row, bucket, found = sparse_entries(batch, "entries", "bin")
                places = _places(trees, depth, (row, bucket, found), len(batch), by_bin=True)
                labels = batch.column("labels").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
                cell = np.searchsorted(known, bucket) * bins + found
                for s, (n, positives) in counts.items():
                    group = np.full(2 << depth, -1)
                    group[active[s]] = np.arange(len(active[s]))
                    group = group[places[s]]
                    some = np.flatnonzero(group[row] >= 0)
                    at = group[row[some]] * width + cell[some]
                    n += np.bincount(at, minlength=len(n))
                    y = np.nan_to_num(labels[:, s])[row[some]]  # an unknown label counts as none
                    positive = y != 0
                    positives += np.bincount(at[positive], y[positive], minlength=len(n))
            for s, sums in counts.items():
                n, positives = sums.reshape(2, -1, bins)
                seen = np.flatnonzero(n.any(axis=1))
                node = np.array(active[s])[seen // max(1, len(known))]
                keys = [np.full(len(seen), s), node, known[seen % max(1, len(known))]]
                columns = [pa.array(k, pa.int32()) for k in keys]
                columns += [pa.array(x[seen, b]) for x in (n, positives) for b in range(bins)]
                yield pa.RecordBatch.from_arrays(columns, names)

        return counted

    rows = binned.select("labels", "entries")
    found = [rows.mapInArrow(counter(subjects), schema) for subjects in parts]
    cells = reduce(DataFrame.unionByName, found)
    return cells.groupBy("subject", "node", "bucket").agg(*[F.sum(c).alias(c) for c in names[3:]])


def _best_splits(histograms: DataFrame, totals: DataFrame, cuts: DataFrame, bins: int) -> DataFrame:
    """(subject, node, bucket, threshold, split, zero_bin, gain, nl, pl) of the best split of each node."""

    joined = histograms.join(F.broadcast(totals), ["subject", "node"]).join(cuts, "bucket")
    listed = {c: sum((F.col(f"{c}{b}") for b in range(1, bins)), F.col(f"{c}0")) for c in "np"}

    def left(c: str, split: int) -> Column:
        """Documents in bins up to the split, those without an entry in the bin of zero."""
        known = sum((F.col(f"{c}{b}") for b in range(1, split + 1)), F.col(f"{c}0"))
        return known + F.when(F.col("zero_bin") <= split, F.col(f"{c}_all") - listed[c]).otherwise(0.0)

    splits = [
        F.struct(
            F.get("cuts", F.lit(i)).alias("threshold"), F.lit(i).alias("split"), left("n", i).alias("nl"), left("p", i).alias("pl")
        )
        for i in range(bins - 1)
    ]
    each = joined.select("subject", "node", "bucket", "zero_bin", "n_all", "p_all", F.inline(F.array(*splits)))
    nr, pr = F.col("n_all") - F.col("nl"), F.col("p_all") - F.col("pl")
    parted = each.where(F.col("threshold").isNotNull() & (F.col("nl") > 0) & (nr > 0))
    children = F.col("nl") / F.col("n_all") * _entropy(F.col("nl"), F.col("pl")) + nr / F.col("n_all") * _entropy(nr, pr)
    gain = F.round(_entropy(F.col("n_all"), F.col("p_all")) - children, _GAIN_DIGITS)
    scored = parted.withColumn("gain", gain).where(F.col("gain") > 0)
    order = F.struct("gain", -F.col("bucket"), -F.col("split"))
    best = F.max_by(F.struct("bucket", "threshold", "split", "zero_bin", "gain", "nl", "pl"), order)
    return scored.groupBy("subject", "node").agg(best.alias("best")).select("subject", "node", "best.*")


def grow(examples: DataFrame, names: list[str], depth: int, bins: int = BINS, split_rows: int = SPLIT_ROWS) -> Trees:
    """One tree a name from the ``train`` rows of (doc_id, split, labels ARRAY<DOUBLE>, vec), a stage table."""
    spark = examples.sparkSession
    train = examples.where(F.col("split") == "train")
    sizes = train.agg(
        F.count("*").alias("n"), *[F.sum(F.get("labels", F.lit(s))).alias(f"p{s}") for s in range(len(names))]
    ).first()
    trees = Trees(list(names), depth, [{1: Node(sizes["n"], sizes[f"p{s}"] or 0.0)} for s in range(len(names))])
    cuts = stage(thresholds(train, bins, split_rows), "cuts")
    binned = stage(binned_rows(train, cuts, bins), "binned")
    buckets = cuts.select("bucket").orderBy("bucket").toArrow().column("bucket").to_numpy()  # at most one row a bucket
    for level in range(depth):
        open_nodes = [
            (s, i, float(x.n), float(x.positives))
            for s, nodes in enumerate(trees.nodes)
            for i, x in nodes.items()
            if x.open and i.bit_length() - 1 == level
        ]
        if not open_nodes:
            break
        totals = spark.createDataFrame(open_nodes, "subject int, node int, n_all double, p_all double")
        histograms = _level_histograms(binned, trees, level, buckets, bins)
        for row in _best_splits(histograms, totals, cuts, bins).collect():
            nodes, i = trees.nodes[row["subject"]], row["node"]
            node = nodes[i]
            node.bucket, node.threshold, node.gain = row["bucket"], row["threshold"], row["gain"]
            node.bin, node.zero_bin = row["split"], row["zero_bin"]
            nodes[2 * i] = Node(int(row["nl"]), row["pl"])
            nodes[2 * i + 1] = Node(node.n - int(row["nl"]), node.positives - row["pl"])
    return trees


def predictions(trees: Trees, examples: DataFrame, depths: list[int]) -> DataFrame:
    """(doc_id, split, subject, depth, label, prediction) of trees cut off at each of the depths."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = _places(trees, trees.depth, sparse_entries(batch, "vec"), len(batch), by_bin=False)
            offsets = pa.array(np.arange(len(batch) + 1) * len(places), pa.int32())
            columns = [batch.column(c) for c in ("doc_id", "split", "labels")]
            nodes = pa.ListArray.from_arrays(offsets, pa.array(places.T.ravel()))
            yield pa.RecordBatch.from_arrays([*columns, nodes], ["doc_id", "split", "labels", "nodes"])

    kind = examples.schema["doc_id"].dataType.simpleString()
    rows = examples.select("doc_id", "split", "labels", "vec").mapInArrow(
        placed, f"doc_id {kind}, split string, labels array<double>, nodes array<int>"
    )

    def outcome(s: int, depth: int) -> Column:
        # the ancestor of the leaf at this depth
        voted: dict[float, list[int]] = {0.0: [], 1.0: []}
        for i in trees.nodes[s]:
            top = i >> max(0, i.bit_length() - 1 - depth)
            voted[trees.nodes[s][top].prediction].append(i)
        positive = F.get("nodes", F.lit(s)).isin(voted[1.0]) if voted[1.0] else F.lit(False)
        return F.struct(
            F.lit(trees.names[s]).alias("subject"),
            F.lit(depth).alias("depth"),
            F.get("labels", F.lit(s)).alias("label"),
            positive.cast("double").alias("prediction"),
        )

    outcomes = [outcome(s, d) for s in range(len(trees.names)) for d in depths]
    return rows.select("doc_id", "split", F.inline(F.array(*outcomes)))
