"""Removal of passages that an earlier document holds, with Burrows-Wheeler transforms of sharded passages.

Whether two documents share a string of ``length`` bytes is decided in shards. The least of the hashed grams in a
string names its shard, so that equal strings meet. Documents lie in hash buckets:

1. each bucket sends the distinct least grams of its texts;
2. each shard answers which grams more than one bucket holds;
3. each bucket sends, for every gram that is shared (between buckets, or between its own documents), the stretches of
   text whose strings have that least gram, equal stretches once, with the smallest document that holds them;
4. each shard transforms its stretches and expands intervals of equal prefixes breadth first, by one byte to the left at
   each level. Prefixes common to neighbouring suffixes come out by increasing value; at the minimum length expansion
   stops, and what is still together is a repeated string, first held by the smallest document of its interval;
5. each bucket takes the marked bytes out of its texts.

A stretch that thousands of documents share is sent once by each bucket (equal hashes only propose that; the bytes are
compared), so that no group of copies grows beyond the number of buckets. A gram that many buckets hold may stand in as
many contexts as there are documents: its stretches are cut once more, by the bytes around the gram that its strings have
in common, and each part goes to a shard of its own. Texts are shuffled once; the three steps on buckets read the same
exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructField, StructType

from ..operators.ranks import ranked
from .frames import partitions, text_bytes, tidy_group, tidy_groups
from .kernels import gram_hashes, mix, sliding_min, utf8

_STEP = 1 << 16
_BUCKET_BYTES = 8 << 20
#: Bytes of stretches in one transform; those of one gram always share one, unless so many buckets hold the gram.
_TRANSFORM = 1 << 20
_COMMON = 64
_LATE = np.iinfo(np.int64).max


def stretches(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of neighbouring strings of ``length`` bytes in a row that have the same least gram.

    Returns the least gram's hash, the row, the place of the first string in ``data`` and the number of strings.
    """
    grams, rows, places, counts = [], [], [], []
    width = length - gram + 1
    for a in range(0, max(0, len(data) - length + 1), _STEP):
        least = sliding_min(gram_hashes(data[a : a + _STEP + length - 1], gram), width)
        e = a + len(least)
        r0, r1 = np.searchsorted(offsets, [a, e - 1], side="right") - 1
        edge = np.clip(offsets[r0 : r1 + 2], a, e)
        row = np.repeat(np.arange(r0, r1 + 1), np.diff(edge))
        inside = np.arange(a, e) + length <= np.repeat(offsets[r0 + 1 : r1 + 2], np.diff(edge))
        begins = np.ones(len(least), bool)
        begins[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
        begins &= inside
        at = np.flatnonzero(begins)
        run = np.cumsum(begins) - 1
        grams.append(least[at])
        rows.append(row[at])
        places.append(at + a)
        counts.append(np.bincount(run[inside], minlength=len(at)) if len(at) else np.zeros(0, np.int64))
    if not grams:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    return np.concatenate(grams), *(np.concatenate(x).astype(np.int64) for x in (rows, places, counts))


def by_context(
    data: np.ndarray, grams: np.ndarray, places: np.ndarray, counts: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches cut where the bytes around their least gram change: hash of these bytes, the stretch, place and count.

    A string has ``length - gram`` bytes besides its first least gram, on the left or on the right. Thirds of them make
    three kinds of strings, and all strings of a kind with one gram hold the same two thirds, whatever else they hold.
    """
    third = -(-(length - gram) // 3)
    text, starts = _gather(data, places, counts + length - 1, 0)
    of = np.repeat(np.arange(len(places)), counts + length - 1)
    hashes = gram_hashes(text, gram)
    at = np.where(hashes == grams[of[: len(hashes)]], np.arange(len(hashes)), len(text))
    nearest = np.minimum.accumulate(at[::-1])[::-1]  # the first least gram from each place on
    stretch = np.repeat(np.arange(len(places)), counts)
    inner = np.arange(len(stretch)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = starts[stretch] + inner
    found = nearest[first]
    left = third * np.maximum(0, (found - first - 1) // third)
    context = gram_hashes(text, length - third)[found - left]
    new = np.ones(len(stretch), bool)
    new[1:] = (stretch[1:] != stretch[:-1]) | (context[1:] != context[:-1])
    begin = np.flatnonzero(new)
    return mix(context[begin] + np.uint64(1)), stretch[begin], places[stretch[begin]] + inner[begin], np.diff(
        np.concatenate([begin, [len(stretch)]])
    )


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes in order of at least their first ``depth`` symbols; equals by place. ``codes`` ends with its only 0."""
    n = len(codes)
    bits = max(1, int(codes.max()).bit_length())
    place = max(1, (n - 1).bit_length())
    reach = max(1, (64 - place) // bits)
    padded = np.concatenate([codes.astype(np.uint64), np.zeros(reach, np.uint64)])
    key = np.zeros(n, np.uint64)
    for i in range(reach):
        key = key << np.uint64(bits) | padded[i : i + n]
    if 3 * place > 64:
        return _long_order(key, reach, depth)
    low = np.uint64((1 << place) - 1)
    key = np.sort(key << np.uint64(place) | np.arange(n, dtype=np.uint64))
    order = (key & low).astype(np.int64)
    new = np.ones(n, bool)
    new[1:] = key[1:] >> np.uint64(place) != key[:-1] >> np.uint64(place)
    rank = np.empty(n + 1, np.uint64)
    rank[n] = 0

    while reach < depth:
        # groups by the place of their first member; only members of larger groups are sorted on
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order] = first
        alone = new.copy()
        alone[:-1] &= new[1:]
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        at = order[slots]
        key = np.sort(rank[at] << np.uint64(2 * place) | rank[np.minimum(at + reach, n)] << np.uint64(place) | at.astype(np.uint64))
        order[slots] = (key & low).astype(np.int64)
        differs = np.ones(len(slots), bool)
        differs[1:] = key[1:] >> np.uint64(place) != key[:-1] >> np.uint64(place)
        new[slots] |= differs
        reach *= 2
    return order


def _long_order(key: np.ndarray, reach: int, depth: int) -> np.ndarray:
    """The same for texts whose places don't fit three times into 64 bits."""
    n = len(key)
    order = np.argsort(key, kind="stable")
    rank = np.zeros(n + 1, np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
    while reach < depth:
        second = rank[np.minimum(np.arange(n) + reach, n)]
        order = np.lexsort((np.arange(n), second, rank[:n]))
        a, b = rank[:n][order], second[order]
        rank[order] = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))])
        reach *= 2
    return order


def common_prefixes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order of a text and, for each but the first suffix of it, the prefix shared with the one before, up to ``length``.

    Backward extension on the Burrows-Wheeler transform: the suffixes that begin with the string cw are those in front of
    which the interval of w has a c. So two neighbours whose first byte is equal part at level l + 1 if and only if what
    follows them parted at level l. Levels go on while intervals part, and at most to ``length``.
    """
    alphabet = np.zeros(256, np.int64)
    used = np.flatnonzero(np.bincount(text, minlength=256))
    alphabet[used] = np.arange(1, len(used) + 1)
    codes = np.concatenate([alphabet[text], [0]])
    n = len(codes)
    order = suffix_order(codes, length + 2)
    transform = codes[order - 1]
    onward = np.argsort(transform.astype(np.uint16), kind="stable").astype(np.int32)  # where the suffix one byte shorter stands
    front = transform[onward]
    shared = np.full(n, length, np.int16)
    shared[0] = 0
    parted = np.ones(n, bool)
    parted[1:] = front[1:] != front[:-1]
    shared[parted] = 0
    left = np.flatnonzero(~parted).astype(np.int32)
    before, behind = onward[left - 1], onward[left]
    for level in range(1, length):
        interval = np.cumsum(parted, dtype=np.int32)
        parts = interval.take(before) != interval.take(behind)
        if not parts.any():
            break  # no pair shares just this much, so none shares just more
        out, stay = left[parts], ~parts
        shared[out] = level
        parted[out] = True
        left, before, behind = left[stay], before[stay], behind[stay]
    return order, shared


def first_holders(text: np.ndarray, starts: np.ndarray, counts: np.ndarray, owners: np.ndarray, length: int) -> np.ndarray:
    """For each string of each stretch, in order, the smallest owner of an equal string.

    ``text`` holds the stretches, each followed by the byte 255; stretch i starts at ``starts[i]``, has ``counts[i]``
    strings and belongs to ``owners[i]``.
    """
    order, shared = common_prefixes(text, length)
    interval = np.empty(len(order), np.int64)
    interval[order] = np.cumsum(shared < length) - 1
    place = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    own = interval[place]
    owner = np.repeat(owners, counts)
    least = np.full(len(order), _LATE, np.int64)
    by = np.argsort(own, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], own[by][1:] != own[by][:-1]])) if len(by) else np.zeros(0, np.int64)
    if len(by):
        least[own[by][cut]] = np.minimum.reduceat(owner[by], cut)
    return least[own]


def _gather(data: np.ndarray, places: np.ndarray, sizes: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of data one after the other, ``gap`` bytes of 255 behind each, and where each starts."""
    full = sizes + gap
    starts = np.cumsum(full) - full
    at = np.arange(int(full.sum())) + np.repeat(places - starts, full)
    out = data[np.minimum(at, max(0, len(data) - 1))] if len(data) else np.zeros(0, np.uint8)
    if gap:
        out[starts + sizes] = 255
    return out, starts


def _merged(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Spans of rows as int32 triples, touching and overlapping ones made one."""
    if not len(row):
        return np.zeros((0, 3), np.int32)
    by = np.lexsort((start, row))
    row, start, end = row[by], start[by], end[by]
    far = np.maximum.accumulate(end + row * (1 << 40)) - row * (1 << 40)
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > far[:-1])
    first = np.flatnonzero(new)
    return np.stack([row[first], start[first], np.maximum.reduceat(end, first)], axis=1).astype(np.int32)


def _sorted_docs(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's rows by key and text, whatever order the shuffle brought; their keys and bytes."""
    table = table.take(pc.sort_indices(table, sort_keys=[("_o", "ascending"), ("_text", "ascending")]))
    data, offsets = utf8(table.column("_text"))
    return table, table.column("_o").to_numpy(), data, offsets


_PIECES = "_shard int, _b int, _bytes binary, _sizes binary, _grams binary, _owners binary, _rows binary, _places binary, _marks binary"


def remove_repeats(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
    length: int = 50,
    gram: int = 20,
    decode: bool = False,
) -> DataFrame:
    """``key``, the columns named in ``carry``, ``n_bytes``, ``spans`` (removed: array of start and end, maximal) and ``kept`` (binary) of every row.

    With ``decode``, ``kept`` is a string; of a character that is cut through, what is left is dropped.

    A byte goes if a string of ``length`` bytes covers it that also starts in a document with a smaller key. Strings are
    judged on the input, in UTF-8; matches don't cross documents; null text is empty. Keys may have any type that has an
    order; null keys are larger than all others; rows of equal key don't count against each other; texts of any length count whole; an empty table gives no rows;
    no other column is read.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    buckets = max(2 * parts, text_bytes(docs, text) // _BUCKET_BYTES)
    shards = buckets
    rows = docs.select(
        F.col(key).alias("_k"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        *[F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)],
    )
    if isinstance(docs.schema[key].dataType, IntegralType):
        rows = rows.withColumn("_o", F.col("_k").cast("long"))
    else:  # any other key counts by its place among all
        numbers = ranked(rows.select(F.col("_k").alias("_key")).where("_k IS NOT NULL").distinct(), ["_key"]).rows("_o")
        rows = rows.join(numbers, F.col("_k") == F.col("_key"), "left").drop("_key")
    rows = rows.withColumn("_o", F.coalesce("_o", F.lit(_LATE)))
    # by text too, so that rows of one key, or of none, don't share a bucket
    rows = rows.withColumn("_b", F.pmod(F.xxhash64("_o", "_text"), F.lit(buckets)).cast("int"))

    def code(grams: np.ndarray) -> np.ndarray:
        return (grams >> np.uint64(32)) % np.uint64(shards) << np.uint64(32) | grams & np.uint64(0xFFFFFFFF)

    def ask(table: pa.Table) -> pa.Table:
        _, _, data, offsets = _sorted_docs(table)
        codes = np.unique(code(stretches(data, offsets, length, gram)[0]))
        return _by_shard(codes, table.column("_b")[0].as_py())

    def answer(table: pa.Table) -> pa.Table:
        held = [np.frombuffer(x.as_py(), np.uint32) for x in table.column("_codes")]
        bucket = np.repeat(table.column("_b").to_numpy(), [len(x) for x in held])
        codes = np.concatenate(held)
        by = np.argsort(codes, kind="stable")
        new = np.concatenate([[True], codes[by][1:] != codes[by][:-1]])
        size = np.diff(np.concatenate([np.flatnonzero(new), [len(codes)]]))
        shared = np.repeat(size > 1, size)
        codes, bucket, common = codes[by][shared], bucket[by][shared], np.repeat(size >= _COMMON, size)[shared]
        by = np.lexsort((codes, bucket))
        codes, bucket, common = codes[by], bucket[by], common[by]
        to, first = np.unique(bucket, return_index=True)
        shard = table.column("_shard")[0].as_py()
        edges = [*first, len(codes)]
        parts_ = [slice(a, e) for a, e in zip(edges, edges[1:], strict=False)][: len(to)]
        return pa.table(
            {
                "_shard": pa.array([shard] * len(to), pa.int32()),
                "_b": pa.array(to, pa.int32()),
                "_codes": pa.array([codes[i].tobytes() for i in parts_], pa.binary()),
                "_common": pa.array([codes[i][common[i]].tobytes() for i in parts_], pa.binary()),
            }
        )

    def _by_shard(codes: np.ndarray, bucket: int) -> pa.Table:
        shard = (codes >> np.uint64(32)).astype(np.int32)
        to, first = np.unique(shard, return_index=True)
        low = (codes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return pa.table(
            {
                "_shard": pa.array(to, pa.int32()),
                "_b": pa.array([bucket] * len(to), pa.int32()),
                "_codes": pa.array([x.tobytes() for x in np.split(low, first[1:])][: len(to)], pa.binary()),
            }
        )

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({n: pa.array([], t) for n, t in zip("_shard _b _bytes _sizes _grams _owners _rows _places _marks".split(), [pa.int32()] * 2 + [pa.binary()] * 7, strict=True)})
        if not left.num_rows:
            return empty
        _, keys, data, offsets = _sorted_docs(left)
        bucket = left.column("_b")[0].as_py()
        grams, row, place, count = stretches(data, offsets, length, gram)
        codes = code(grams)
        whole = lambda column: [np.uint64(s.as_py()) << np.uint64(32) | np.frombuffer(c.as_py(), np.uint32).astype(np.uint64) for s, c in zip(right.column("_shard"), right.column(column), strict=True)]
        asked, common = whole("_codes"), np.concatenate([np.zeros(0, np.uint64), *whole("_common")])
        # shared with other buckets, or by two documents of this one
        by = np.lexsort((keys[row], codes))
        differ = (codes[by][1:] == codes[by][:-1]) & (keys[row][by][1:] != keys[row][by][:-1])
        wanted = np.unique(np.concatenate([*asked, codes[by][1:][differ]])) if asked or differ.any() else np.zeros(0, np.uint64)
        at = np.searchsorted(wanted, codes)
        take = np.flatnonzero(
            (at < len(wanted)) & (wanted[np.minimum(at, max(0, len(wanted) - 1))] == codes)
        ) if len(wanted) else np.zeros(0, np.int64)
        if not len(take):
            return empty
        grams, codes, row, place, count = grams[take], codes[take], row[take], place[take], count[take]
        if (cut := np.isin(codes, common)).any():
            contexts, of, *parts_ = by_context(data, grams[cut], place[cut], count[cut], length, gram)
            codes = np.concatenate([codes[~cut], code(contexts)])
            row = np.concatenate([row[~cut], row[cut][of]])
            place, count = (np.concatenate([x[~cut], y]) for x, y in zip((place, count), parts_, strict=True))
        size = count + length - 1
        # equal stretches: the smallest document keeps its own, the others are marked
        by, new = _equals(data, codes, place, size, keys[row])
        least = np.repeat(keys[row][by][new], np.diff(np.concatenate([np.flatnonzero(new), [len(by)]])))
        own = keys[row][by] == least
        marked, kept = by[~own], by[own]
        start = place - offsets[row]
        marks = _merged(row[marked], start[marked], (start + size)[marked])
        out = [empty]
        shard = (codes[kept] >> np.uint64(32)).astype(np.int32)
        cut = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
        for a, e in zip(cut, [*cut[1:], len(kept)], strict=True):
            i = kept[a:e]
            packed = [
                _gather(data, place[i], size[i], 0)[0],
                size[i].astype(np.int32),
                codes[i].astype(np.uint32),
                keys[row[i]],
                row[i].astype(np.int32),
                start[i].astype(np.int32),
            ]
            out.append(pa.table({"_shard": pa.array([shard[a]], pa.int32()), "_b": pa.array([bucket], pa.int32()), **{n: pa.array([x.tobytes()], pa.binary()) for n, x in zip("_bytes _sizes _grams _owners _rows _places".split(), packed, strict=True)}, "_marks": pa.array([None], pa.binary())}))
        if len(marks):
            out.append(
                pa.table(
                    {
                        "_shard": pa.array([bucket % shards], pa.int32()),
                        "_b": pa.array([bucket], pa.int32()),
                        **{n: pa.array([None], pa.binary()) for n in "_bytes _sizes _grams _owners _rows _places".split()},
                        "_marks": pa.array([marks.tobytes()], pa.binary()),
                    }
                )
            )
        return pa.concat_tables(out)

    def decide(table: pa.Table) -> pa.Table:
        to, marks = [], []
        for b, m in zip(table.column("_b").to_pylist(), table.column("_marks"), strict=True):
            if m.is_valid:
                to.append(b)
                marks.append(m.as_py())
        table = table.filter(pc.is_valid(table.column("_bytes")))
        if table.num_rows:
            read = {n: np.concatenate([np.frombuffer(x.as_py(), t) for x in table.column(n)]) for n, t in (("_bytes", np.uint8), ("_sizes", np.int32), ("_grams", np.uint32), ("_owners", np.int64), ("_rows", np.int32), ("_places", np.int32))}
            per_row = [len(x.as_py()) // 4 for x in table.column("_sizes")]
            bucket = np.repeat(table.column("_b").to_numpy(), per_row)
            size = read["_sizes"].astype(np.int64)
            begin = np.cumsum(size) - size
            by, new = _equals(read["_bytes"], read["_grams"], begin, size, read["_owners"])
            one = by[new]  # each stretch once, with its smallest document
            same = np.empty(len(by), np.int64)
            same[by] = np.cumsum(new) - 1
            # as many grams at a time as make up one transform
            weight = np.cumsum(size[one] + 1)
            gram_new = np.concatenate([[True], read["_grams"][one][1:] != read["_grams"][one][:-1]])
            gram_first = np.maximum.accumulate(np.where(gram_new, np.arange(len(one)), 0))
            batch = weight[gram_first] // _TRANSFORM
            cuts = np.flatnonzero(np.concatenate([[True], batch[1:] != batch[:-1]]))
            firsts = []
            for a, e in zip(cuts, [*cuts[1:], len(one)], strict=True):
                i = one[a:e]
                bytes_, starts = _gather(read["_bytes"], begin[i], size[i], 1)
                firsts.append(first_holders(bytes_, starts, size[i] - length + 1, read["_owners"][i], length))
            first = np.concatenate(firsts)
            # back to every stretch that came in
            counts = size - length + 1
            before = (np.cumsum(counts[one]) - counts[one])[same]
            string = np.repeat(before - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            late = first[string] < np.repeat(read["_owners"], counts)
            of = np.repeat(np.arange(len(counts)), counts)[late]
            start = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))[late] + read["_places"][of]
            by = np.argsort(bucket[of], kind="stable")
            of, start = of[by], start[by]
            held, cut = np.unique(bucket[of], return_index=True)
            for b, a, e in zip(held.tolist(), cut, [*cut[1:], len(of)], strict=False):
                to.append(b)
                marks.append(_merged(read["_rows"][of[a:e]].astype(np.int64), start[a:e], start[a:e] + length).tobytes())
        return pa.table({"_b": pa.array(to, pa.int32()), "_marks": pa.array(marks, pa.binary())})

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        table, _, data, offsets = _sorted_docs(left)
        spans = np.concatenate(
            [np.zeros((0, 3), np.int32), *[np.frombuffer(x.as_py(), np.int32).reshape(-1, 3) for x in right.column("_marks")]]
        ).astype(np.int64)
        spans = _merged(spans[:, 0], spans[:, 1], spans[:, 2]).astype(np.int64)
        first = np.searchsorted(spans[:, 0], np.arange(table.num_rows + 1))
        raw, kept, removed = data.tobytes(), [], []
        for i in range(table.num_rows):
            own = spans[first[i] : first[i + 1], 1:]
            a, parts_ = int(offsets[i]), []
            at = a
            for s, e in own:
                parts_.append(raw[at : a + s])
                at = a + int(e)
            parts_.append(raw[at : int(offsets[i + 1])])
            kept.append(b"".join(parts_).decode("utf-8", "ignore") if decode else b"".join(parts_))
            removed.append([{"start": int(s), "end": int(e)} for s, e in own])
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        carried = {c: table.column(f"_carry{i}") for i, c in enumerate(carry)}
        return pa.table(
            {
                key: table.column("_k"),
                **carried,
                "n_bytes": pa.array(np.diff(offsets)),
                "spans": pa.array(removed, span),
                "kept": pa.array(kept, pa.string() if decode else pa.binary()),
            }
        )

    asked = rows.groupBy("_b").applyInArrow(tidy_group(ask), "_shard int, _b int, _codes binary")
    shared = asked.groupBy("_shard").applyInArrow(tidy_group(answer), "_shard int, _b int, _codes binary, _common binary")
    sent = rows.groupBy("_b").cogroup(shared.groupBy("_b")).applyInArrow(tidy_groups(send), _PIECES)
    marks = sent.groupBy("_shard").applyInArrow(tidy_group(decide), "_b int, _marks binary")
    found = StructType.fromDDL(f"n_bytes long, spans array<struct<start:long,end:long>>, kept {'string' if decode else 'binary'}")
    own = [StructField(c, docs.schema[c].dataType) for c in (key, *carry)]  # with the nullability of what is nested
    return rows.groupBy("_b").cogroup(marks.groupBy("_b")).applyInArrow(tidy_groups(apply), StructType([*own, *found]))


def _equals(
    data: np.ndarray, grams: np.ndarray, places: np.ndarray, sizes: np.ndarray, owners: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal pieces of data with one gram follow each other, by owner, and where each set of these begins.

    Hashes bring equal pieces together, and their bytes are compared; pieces that only share a hash stay apart.
    """
    content = _content(data, places, sizes)
    by = np.lexsort((owners, content, sizes, grams))
    new = np.ones(len(by), bool)
    new[1:] = (grams[by][1:] != grams[by][:-1]) | (sizes[by][1:] != sizes[by][:-1]) | (content[by][1:] != content[by][:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
    again = np.flatnonzero(~new)
    differ = again[~_same(data, places[by[first[again]]], places[by[again]], sizes[by[again]])]
    if len(differ):
        new |= np.isin(first, first[differ])
    return by, new


def _words(data: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of pieces of data 8 bytes after the other as numbers, what lies beyond a piece as 0; and which pieces reach there."""
    words = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
    for k in range(0, int(sizes.max(initial=0)), 8):
        live = np.flatnonzero(sizes > k)
        over = np.maximum(0, 8 - (sizes[live] - k)).astype(np.uint64) * np.uint64(8)
        # little-endian: bytes beyond the piece are the high ones
        yield live, np.ascontiguousarray(words[places[live] + k]).view(np.uint64)[:, 0] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> over)


def _same(data: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the pieces at ``a`` and ``b`` hold the same bytes."""
    same = np.ones(len(a), bool)
    for (live, left), (_, right) in zip(_words(data, a, sizes), _words(data, b, sizes), strict=True):
        same[live] &= left == right
    return same


def _content(data: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece of data."""
    value = mix(sizes.astype(np.uint64))
    for live, word in _words(data, places, sizes):
        value[live] = mix(value[live] * np.uint64(0x9E3779B97F4A7C15) + word)
    return value
