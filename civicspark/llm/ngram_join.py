"""Jaccard self-join of documents on word shingles, by vertical partitioning of the shingle order.

Documents with equal shingle sets form one class and stand for one node. First the shingles that more than one node
holds are found, and how many do, in groups dealt by hash. They make up the global order, rarest first, and two nodes
can only reach the threshold if they meet in the first part of it (prefix filter).

The order is cut at its quantiles into fragments. Each node's shingles lie in segments, one a fragment; for candidate
pairs every fragment counts the overlap of two segments for itself, and the partial overlaps are summed per pair.

Links matter as far as they connect. Candidates are first tried against a centre for each shingle, and where a shingle's
nodes still stand apart, against others; then all candidate pairs that still stand in different components are counted,
but for those whose parity bitmaps already differ in more bits than the sets may in shingles. A group of m near copies
so costs about m pairs instead of m * m / 2, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .frames import discard, materialize, partitions, tidy, tidy_group, tidy_groups
from .kernels import mix, shingle_sets, utf8

#: Shingles of a group in which equal ones are sought, and of the slices of text that are hashed at once, in bytes.
_GROUP = 5 << 19
_SLICE = 1 << 18
#: Shingles that a task gathers before it sends them off.
_GATHERED = 1 << 19
#: Of one in so many sets, by hash: shingles that so many of these hold are common; at most so many, 8 bytes each, are listed.
_SAMPLE, _COMMON, _LISTED = 4096, 64, 100_000
#: Fragments that the order is cut into.
_FRAGMENTS = 8
#: 64-bit words of a parity bitmap; further rounds against centres, and a group's centres in each. None changes the result.
_WORDS = 8
_ROUNDS = 2
_CENTRES = 8
#: Parts that a shingle's nodes are dealt to.
_PARTS = 8
#: Nodes of a shingle up to which the last pairs are formed by a join, at most half of this squared; nodes of a block in one task.
_FEW, _BLOCK = 32, 1024
#: Nodes of pairs that are broadcast, 16 bytes each; more are joined by shuffle.
_BROADCAST = 1 << 20


def _sets(column: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of rows with their distinct shingles, so that a batch of long texts doesn't stand in memory at once."""
    data, offsets = utf8(column)
    rows, lo = len(offsets) - 1, 0
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + _SLICE, side="right")) - 1)
        values, at = shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], words)
        yield lo, hi, values, at
        lo = hi


def _keys(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set: equal sets have equal names."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(0xA5A5A5A55A5A5A5A)))])
    return mix(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64)


def set_names(docs: DataFrame, *, key: str, text: str, words: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """``_k``, the columns named in ``carry``, ``n`` (shingles) and ``node``, the name of the row's shingle set, null if that is empty."""
    frame = docs.select(F.col(key).alias("_k"), text, *carry)
    arrow = to_arrow_type(frame.schema["_k"].dataType)
    kinds = "".join(f"`{c}` {frame.schema[c].dataType.simpleString()}, " for c in carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, values, at in _sets(batch.column(1), words):
                n = np.diff(at)
                carried = [batch.column(2 + i).slice(lo, hi - lo) for i in range(len(carry))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).cast(arrow), *carried, pa.array(n), pa.array(_keys(values, at), mask=n == 0)],
                    names=["_k", *carry, "n", "node"],
                )

    return frame.mapInArrow(tidy(run), f"_k {frame.schema['_k'].dataType.simpleString()}, {kinds}n long, node long")


def _common(docs: DataFrame, text: str, words: int) -> np.ndarray:
    """Shingles that a sample of the sets shows to be common, ascending.

    Each has been seen in many sets, so it is shared for certain. Missing one costs only time: the list decides which way
    a shingle goes, not the result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(0, np.int64)
        for batch in batches:
            for _, _, values, at in _sets(batch.column(0), words):
                names = _keys(values, at)
                new = ~np.isin(names, met) & (np.diff(at) > 0)
                met = np.unique(np.concatenate([met, names[new]]))
                keep = np.repeat(new, np.diff(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(names, np.diff(at))[keep]), pa.array(values[keep].view(np.int64))], names=["node", "shingle"]
                )

    sampled = docs.where(
        F.pmod(F.xxhash64(text), F.lit(_SAMPLE)) == 0
    ).select(text).mapInArrow(tidy(run), "node long, shingle long").distinct()
    counts = sampled.groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") >= _COMMON)
    found = counts.orderBy(F.desc("n"), "shingle").limit(_LISTED).select("shingle").collect()
    return np.sort(np.array([r["shingle"] for r in found], np.int64).view(np.uint64))


def _dealt(docs: DataFrame, text: str, words: int, groups: int, common: np.ndarray) -> DataFrame:
    """The sets of each batch of rows, equal sets once, dealt to groups by hash: shingles one after the other, by node.

    A common shingle would bring a row of most nodes into one group. It goes with its place in the list to a group of its
    nodes' bucket instead, a negative one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(0, np.int64)
        shingles, owners, gathered = [], [], 0
        for batch in batches:
            for _, _, values, at in _sets(batch.column(0), words):
                names, size = _keys(values, at), np.diff(at)
                _, first = np.unique(names, return_index=True)
                new = np.zeros(len(names), bool)
                new[first] = True
                new &= ~np.isin(names, met) & (size > 0)
                met = np.concatenate([met, names[new]])
                keep = np.repeat(new, size)
                shingles.append(values[keep])
                owners.append(np.repeat(names, size)[keep])
                gathered += len(shingles[-1])
                if gathered >= _GATHERED:
                    yield from packed(shingles, owners)
                    shingles, owners, gathered = [], [], 0
        if shingles:
            yield from packed(shingles, owners)

    def packed(shingles: list[np.ndarray], owners: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        value, owner = np.concatenate(shingles), np.concatenate(owners)
        group = ((value >> np.uint64(32)) % np.uint64(groups)).astype(np.int32)
        if len(common):
            listed = np.minimum(np.searchsorted(common, value), len(common) - 1)
            held = common[listed] == value
            group, value = np.where(held, -1 - owner % groups, group).astype(np.int32), np.where(held, listed.astype(np.uint64), value)
        order = np.argsort(group, kind="stable")
        group, value, owner = group[order], value[order].astype(np.uint32), owner[order]
        # owners follow each other: each once, with its number of shingles, in parts that a byte can count
        starts = _runs(255, group, owner)
        counts = np.diff(np.concatenate([starts, [len(owner)]])).astype(np.uint8)
        to, first = np.unique(group[starts], return_index=True)
        cuts = np.concatenate([first, [len(starts)]])
        edges = np.concatenate([starts, [len(owner)]])[cuts]
        for i, g in enumerate(to.tolist()):
            row = (
                g,
                value[edges[i] : edges[i + 1]].tobytes(),
                owner[starts[cuts[i] : cuts[i + 1]]].tobytes(),
                counts[cuts[i] : cuts[i + 1]].tobytes(),
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, [pa.int32(), *[pa.binary()] * 3], strict=True)],
                names=["group", "shingles", "nodes", "counts"],
            )

    return docs.select(text).mapInArrow(tidy(run), "group int, shingles binary, nodes binary, counts binary")


def _runs(most: int, *columns: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, a long run every ``most`` places."""
    n = len(columns[0])
    new = np.ones(n, bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return np.flatnonzero((np.arange(n) - first) % most == 0)


def _joined(table: pa.Table, column: str, kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *[np.frombuffer(x.as_py(), kind) for x in table.column(column)]])


def _shared(groups: int) -> Callable[[pa.Table], pa.Table]:
    """Of one group: the shingles that more than one node holds, with a measure of how many do, dealt to buckets of nodes.

    Of a negative group all are common: they are the last ones of the order, under a group number that no other has.
    """

    def run(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        names, of = np.unique(_joined(table, "nodes", np.int64), return_inverse=True)
        of = np.repeat(of.astype(np.uint64), _joined(table, "counts", np.uint8))
        pairs = np.unique(_joined(table, "shingles", np.uint32).astype(np.uint64) << np.uint64(32) | of)
        value = (pairs >> np.uint64(32)).astype(np.uint32)
        begin = _runs(len(value) + 1, value)
        holders = np.diff(np.concatenate([begin, [len(value)]]))
        rank = np.minimum(127, 8 * np.log2(holders)).astype(np.uint8)  # grows with the number of holders
        if group < 0:
            rank[:], holders_needed = 127, 1
        else:
            holders_needed = 2
        held = np.repeat(holders >= holders_needed, holders)
        value, of, rank = value[held], (pairs[held] & np.uint64(0xFFFFFFFF)).astype(np.int64), np.repeat(rank, holders)[held]
        bucket = (names % groups).astype(np.int32)[of]
        order = np.lexsort((of, bucket))
        value, of, rank, bucket = value[order], of[order], rank[order], bucket[order]
        starts = _runs(255, bucket, of) if len(of) else np.zeros(0, np.int64)
        counts = np.diff(np.concatenate([starts, [len(of)]])).astype(np.uint8)
        to, first = np.unique(bucket[starts], return_index=True)
        cuts = np.concatenate([first, [len(starts)]]).astype(np.int64)
        edges = np.concatenate([starts, [len(of)]]).astype(np.int64)[cuts]
        group, out = group if group >= 0 else groups, []
        for i, b in enumerate(to.tolist()):
            of_bucket, here = slice(cuts[i], cuts[i + 1]), slice(edges[i], edges[i + 1])
            out.append(
                (b, group, names[of[starts[of_bucket]]].tobytes(), counts[of_bucket].tobytes(), value[here].tobytes(), rank[here].tobytes())
            )
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        return pa.table(
            {n: pa.array([r[i] for r in out], kinds[i]) for i, n in enumerate(("bucket", "group", "nodes", "counts", "shingles", "ranks"))}
        )

    return run


def _placed(percent: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Of one bucket of nodes: those of which enough shingles are shared, with these in the global order.

    An item is a shingle and its place in the order: rank, group and hash, the rarest first.
    """

    def run(pieces: pa.Table, classes: pa.Table) -> pa.Table:
        names, size = classes.column("node").to_numpy(), classes.column("n").to_numpy()
        by = np.argsort(names)
        names, size = names[by], size[by]
        counts = [np.frombuffer(c.as_py(), np.uint8) for c in pieces.column("counts")]
        group = np.repeat(pieces.column("group").to_numpy().astype(np.int64), [int(c.sum()) for c in counts])
        node = np.searchsorted(names, np.repeat(_joined(pieces, "nodes", np.int64), np.concatenate([np.zeros(0, np.uint8), *counts])))
        item = _joined(pieces, "ranks", np.uint8).astype(np.int64) << 55 | group << 32 | _joined(
            pieces, "shingles", np.uint32
        ).astype(np.int64)
        held = np.bincount(node, minlength=len(names))
        able = 100 * held >= percent * size
        keep = able[node]
        order = np.lexsort((item[keep], node[keep]))
        item, node = item[keep][order], node[keep][order]
        names, size, held = names[able], size[able], held[able]
        offsets = np.concatenate([[0], np.cumsum(held)]).astype(np.int32)
        # a bit is on if it is hit by an odd number of shingles: two sets differ by at least as many as their bitmaps
        row = np.repeat(np.arange(len(names)), held)
        hits = np.bincount(
            row * (64 * _WORDS) + (mix(item.view(np.uint64)) % np.uint64(64 * _WORDS)).astype(np.int64), minlength=len(names) * 64 * _WORDS
        )
        bits = np.packbits((hits % 2).astype(np.uint8).reshape(-1, 64), axis=1).reshape(-1).view(np.int64)
        bitmap = pa.ListArray.from_arrays(pa.array(np.arange(len(names) + 1, dtype=np.int32) * _WORDS), pa.array(bits))
        return pa.table({"node": names, "n": size, "items": pa.ListArray.from_arrays(pa.array(offsets), pa.array(item)), "bitmap": bitmap})

    return run


def _cuts(nodes: DataFrame, fragments: int) -> list[int]:
    """Where the order is cut so that fragments hold about as many shingles of nodes."""
    at = [i / fragments for i in range(1, fragments)]
    found = nodes.select(F.explode("items").alias("item")).agg(
        F.percentile_approx("item", at, 1000).alias("at")
    ).first()["at"] if at else None
    return sorted(set(found or []))


def _links(pairs: DataFrame, nodes: DataFrame, cuts: list[int], percent: int) -> DataFrame:
    """The pairs (a, na, b, nb), a written table, that reach the threshold.

    Each fragment of the order counts the overlap of the segments that a pair has there; these are summed per pair.
    """
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    needed = nodes.select("node", "items").join(F.broadcast(ends) if pairs.count() <= _BROADCAST // 2 else ends, "node", "left_semi")
    lows, highs = [None, *cuts], [*cuts, None]
    inside = lambda lo, hi: lambda x: (F.lit(True) if lo is None else x >= lo) & (F.lit(True) if hi is None else x < hi)
    cut = F.array(*[F.filter("items", inside(lo, hi)) for lo, hi in zip(lows, highs, strict=True)])
    segments = needed.select("node", F.posexplode(cut).alias("fragment", "segment")).where(F.size("segment") > 0)
    left, right = (segments.select(F.col("node").alias(k), "fragment", F.col("segment").alias(f"segment_{k}")) for k in "ab")
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select(
        "a", "na", "b", "nb", F.size(F.array_intersect("segment_a", "segment_b")).alias("part")
    )
    summed = partial.groupBy("a", "na", "b", "nb").agg(F.sum("part").alias("overlap"))
    return summed.where(100 * F.col("overlap") >= percent * (F.col("na") + F.col("nb") - F.col("overlap"))).select("a", "b")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node`` and ``comp``, the smallest node that links reach, a written table, by least labels and pointer jumping."""
    edges = materialize(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct())
    ends = edges.select(F.col("a").alias("node")).distinct()
    labels = written = materialize(ends.withColumn("comp", F.col("node")))
    while True:
        told = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("told"))
        lower = labels.join(told, "node").select("node", F.col("comp").alias("old"), F.least("comp", "told").alias("comp"))
        further = labels.select(F.col("node").alias("comp"), F.col("comp").alias("jump"))
        new = materialize(lower.join(further, "comp").select("node", "old", F.least("comp", "jump").alias("comp")))
        discard(written)
        written, labels = new, new.select("node", "comp")
        if new.where("comp <> old").isEmpty():
            break
    out = materialize(nodes.select("node").join(labels, "node", "left").select("node", F.coalesce("comp", "node").alias("comp")))
    discard(edges, written)
    return out


def join(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 75,
    carry: tuple[str, ...] = (),
    fragments: int = _FRAGMENTS,
) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id``, the smallest key that links reach, of every row.

    With ``carry`` also the columns named there and ``component``, a name of the component that doesn't hang on keys:
    one number for all its rows, null for a row without words.

    Words are split at ASCII white space, A-Z lower-cased; a text with fewer words than a shingle has one, of all its
    words; one without words, or null, has none, and is linked with nothing: its component is its own key. Rows link
    when 100 * overlap >= ``percent`` * union. Repeated rows are one class; null keys are never a component's smallest
    (a component of null keys only is null); an empty table gives no rows; no other column is read.

    Texts of any length count whole; ``fragments`` of the order change the work, not the result. Sets are told apart by
    64-bit names, shingles by 32 bits and their group.
    """
    named = materialize(set_names(docs, key=key, text=text, words=words, carry=carry))
    groups = max(partitions(docs.sparkSession), (named.agg(F.sum("n")).first()[0] or 0) // _GROUP)
    classes = named.where("node is not null").groupBy("node", "n").agg(F.min("_k").alias("first"))

    dealt = _dealt(docs, text, words, groups, _common(docs, text, words)).groupBy("group").applyInArrow(
        tidy_group(_shared(groups)), "bucket int, group int, nodes binary, counts binary, shingles binary, ranks binary"
    )
    sizes = classes.select("node", "n", F.pmod("node", F.lit(groups)).cast("int").alias("bucket"))
    # a node can link only if others hold enough of its shingles, by number
    nodes = materialize(
        dealt.groupBy("bucket").cogroup(sizes.groupBy("bucket")).applyInArrow(
            tidy_groups(_placed(percent)), "node long, n long, items array<long>, bitmap array<long>"
        )
    )
    cuts = _cuts(nodes, fragments)
    # the first part of the order, of which shingles that nobody else holds come first
    prefix = F.floor(F.col("n") * (100 - percent) / 100.0 + 1e-9) + 1 - (F.col("n") - F.size("items"))
    first = F.slice("items", F.lit(1), F.least(prefix, F.size("items")).cast("int"))
    placed = nodes.where(prefix > 0).select(
        "node",
        F.col("n").cast("int").alias("n"),
        (F.col("n") - F.size("items")).cast("int").alias("alone"),
        F.posexplode(first).alias("at", "shingle"),
    )
    prefixes = materialize(placed.select("node", "n", "shingle", (F.col("alone") + F.col("at")).alias("place")))

    # names are hashes, so the least of a shingle's nodes is any of them, and mostly the same one for a group of copies
    one = prefixes.withColumn("comp", F.col("node"))
    used = [nodes, prefixes]

    def linked(pairs: DataFrame) -> DataFrame:
        tried = materialize(pairs)
        found = materialize(_links(tried, nodes, cuts, percent))
        discard(tried)
        used.append(found)
        return found

    links = linked(_tried(one, F.lit(0), percent))
    comps = components(nodes, links)
    for turn in range(1, 1 + _ROUNDS):
        apart = materialize(_apart((prefixes if turn == 1 else apart.drop("comp")).join(comps, "node")))
        used += [apart, comps]
        order = F.xxhash64(F.lit(turn), "node", F.pmod("shingle", F.lit(_CENTRES)))
        links = links.union(linked(_tried(apart, order, percent)))
        comps = components(nodes, links)

    # all pairs that may link and still stand apart
    own = nodes.select("node", "bitmap", (F.col("n") - F.size("items")).cast("int").alias("alone"))
    open_ = materialize(_apart(apart.drop("comp").join(comps, "node")).join(own, "node"))
    rest = _met(open_, percent)
    found = linked(_fit(rest, percent))
    if not found.isEmpty():
        used.append(comps)
        comps = components(nodes, links.union(found))
    discard(*used, open_)

    member = classes.join(comps, "node", "left").select("node", "first", F.coalesce("comp", "node").alias("comp"))
    least = member.groupBy("comp").agg(F.min("first").alias("least"))
    # few components hold more than one class; the others' smallest key is at hand
    merged = member.join(least, "comp").select("node", "least", "comp")
    more = [*carry, F.col("comp").alias("component")] if carry else []
    return named.join(merged, "node", "left").select(
        F.col("_k").alias(key),
        *more,
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("_k")).otherwise(F.col("least")).alias("component_id"),
    )


def _met(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, na, b, nb) of nodes of one shingle and different components that may reach the threshold, by their places
    and by their parity bitmaps.

    Those of a shingle of few nodes are formed by a join. A frequent shingle's nodes are dealt to parts, and a block of any
    two parts is one task's group of bounded size, of which only the pairs that may link come out.
    """
    sizes = rows.groupBy("shingle").agg(F.count("*").alias("m"))
    few = rows.join(sizes.where(F.col("m") <= _FEW).select("shingle"), "shingle")
    other = few.select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "comp", "place", "bitmap", "alone")])
    differ = sum(
        (F.bit_count(F.col("bitmap")[i].bitwiseXOR(F.col("bitmap_b")[i])) for i in range(_WORDS)), F.col("alone") + F.col("alone_b")
    )
    near = (100 + percent) * differ <= (100 - percent) * (F.col("n") + F.col("n_b"))
    small = few.join(other, "shingle").where(
        (F.col("node") < F.col("node_b")) & (F.col("comp") != F.col("comp_b")) & _reach("n", "place", "n_b", "place_b", percent) & near
    ).select(*_pair("node", "n", "node_b", "n_b"))
    many = rows.join(sizes.where(F.col("m") > _FEW), "shingle").withColumn("parts", F.ceil(F.col("m") / _BLOCK).cast("int"))
    dealt = many.withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int"))
    tiles = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "shingle",
        F.least("part", "with").alias("i"),
        F.greatest("part", "with").alias("j"),
        (F.col("part") <= F.col("with")).alias("left"),
        *["node", "n", "comp", "place", "bitmap", "alone"],
    )
    large = tiles.groupBy("shingle", "i", "j").applyInArrow(tidy_group(_block(percent)), "a long, na int, b long, nb int")
    return small.union(large)


def _block(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Of two parts of a shingle's nodes: the pairs that ``_met`` is for."""

    def run(table: pa.Table) -> pa.Table:
        node, n, comp, place, alone = (table.column(c).to_numpy().astype(np.int64) for c in ("node", "n", "comp", "place", "alone"))
        bits = table.column("bitmap").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
        same = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        left = table.column("left").to_numpy(zero_copy_only=False)
        rows, columns = (np.arange(len(node)),) * 2 if same else (np.flatnonzero(left), np.flatnonzero(~left))
        out = [np.zeros((0, 2), np.int64)]
        for i in rows.tolist():
            with_ = columns[columns > i] if same else columns
            with_ = with_[comp[with_] != comp[i]]
            both = n[with_] + n[i]
            reach = (100 + percent) * np.minimum(n[with_] - place[with_], n[i] - place[i]) >= percent * both
            with_, both = with_[reach], both[reach]
            differ = np.bitwise_count(bits[with_] ^ bits[i]).sum(axis=1).astype(np.int64) + alone[with_] + alone[i]
            found = with_[(100 + percent) * differ <= (100 - percent) * both]
            out.append(np.stack([np.full(len(found), i), found], axis=1))
        x, y = np.concatenate(out).T
        x, y = np.where(node[x] < node[y], x, y), np.where(node[x] < node[y], y, x)
        return pa.table({"a": node[x], "na": n[x].astype(np.int32), "b": node[y], "nb": n[y].astype(np.int32)})

    return run


def _pair(a: str, na: str, b: str, nb: str) -> list[Column]:
    swap = F.col(a) > F.col(b)
    return [F.when(swap, F.col(y)).otherwise(F.col(x)).alias(n) for x, y, n in ((a, b, "a"), (na, nb, "na"), (b, a, "b"), (nb, na, "nb"))]


def _parted(rows: DataFrame) -> DataFrame:
    """Rows with a part of their shingle, so that those of a frequent one are in several tasks."""
    return rows.withColumn("part", F.pmod(F.xxhash64("node"), F.lit(_PARTS)).cast("int"))


def _tried(rows: DataFrame, order: Column, percent: int) -> DataFrame:
    """Pairs of nodes that stand in different components: of each part of a shingle with the part's node that is first in
    ``order``, and of these with the shingle's first."""
    parted = _parted(rows)
    centres = parted.groupBy("shingle", "part").agg(F.min(F.struct(order.alias("o"), "node", "n", "comp", "place")).alias("c"))
    paired = parted.join(centres, ["shingle", "part"])
    several = centres.groupBy("shingle").agg(F.min("c").alias("c"), F.collect_list("c").alias("parts")).where(F.size("parts") > 1)
    heads = several.select("c", F.explode("parts").alias("of")).select("c", "of.node", "of.n", "of.comp", "of.place")
    fit = (F.col("comp") != F.col("c.comp")) & _reach("n", "place", "c.n", "c.place", percent)
    pairs = [df.where(fit).select(*_pair("node", "n", "c.node", "c.n")) for df in (paired, heads)]
    return _fit(pairs[0].union(pairs[1]), percent)


def _apart(rows: DataFrame) -> DataFrame:
    """The rows of shingles whose nodes stand in different components."""
    torn = rows.groupBy("shingle").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("shingle")
    parts = torn.withColumn("part", F.explode(F.array(*[F.lit(i) for i in range(_PARTS)])))
    return _parted(rows).join(parts, ["shingle", "part"], "left_semi").drop("part")


def _reach(n: str, place: str, n_b: str, place_b: str, percent: int) -> Column:
    """Whether a pair may reach the threshold if this is the first shingle that both hold, at these places of their orders.
    A pair that links passes at its first common shingle."""
    left = F.least(F.col(n) - F.col(place), F.col(n_b) - F.col(place_b))
    return (100 + percent) * left >= percent * (F.col(n) + F.col(n_b))


def _fit(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs whose sizes allow the threshold."""
    return pairs.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).distinct()
