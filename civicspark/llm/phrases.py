"""Phrase collocations of each language, counted in quotient filters.

Words that are frequent enough get ids; an n-gram of ids is packed into one number, and a bijection spreads these numbers.
The upper bits of a spread number are its quotient, the rest its full remainder, so that a filter holds each n-gram exactly:
a sorted run of remainders for each quotient, run lengths in unary, and a counter of a byte that larger counts overflow.
Each task counts its texts into filters, cut into slices of the number range; filters of one slice are sorted alike and are
merged, and the bijection's inverse gives the ids back.

Only n-grams of frequent words are counted, which loses nothing: a phrase is at most as frequent as each of its words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranks import ranked
from .frames import give_back, materialize, partitions, tidy, tidy_group, tidy_groups
from .kernels import mix, slices, utf8, words

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
#: Ids of up to so many bits are packed three into one 64-bit number; longer ones, up to 32 bits, into two.
_NARROW, _WIDE = 21, 32
#: A vocabulary of up to so many words and bytes goes to all tasks; a larger one is joined to the words of each shard of texts.
_WORDS, _BYTES = 1 << 21, 64 << 20
#: n-grams that a task gathers before it writes filters, n-grams of a slice, entries of a word table, bytes of a shard.
_GATHERED, _SLICE, _TABLE, _SHARD = 1 << 21, 1 << 20, 1 << 18, 32 << 20


@dataclass(frozen=True)
class Layout:
    """How ids of ``bits`` bits are packed, and into how many slices (a power of two) numbers are cut."""

    bits: int
    slice_bits: int

    @property
    def wide(self) -> bool:
        return self.bits > _NARROW

    @property
    def width(self) -> int:
        """Bits of the leading number."""
        return _WIDE if self.wide else 3 * self.bits


def spread(value: np.ndarray, width: int) -> np.ndarray:
    """A bijection of the numbers of ``width`` bits."""
    mask, half = np.uint64((1 << width) - 1), np.uint64((width + 1) // 2)
    for factor in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
        value = (value ^ (value >> half)) * np.uint64(factor) & mask
    return value ^ (value >> half)


def gather(value: np.ndarray, width: int) -> np.ndarray:
    """The inverse of ``spread``: as a shift is half the width or more, it undoes itself."""
    mask, half = np.uint64((1 << width) - 1), np.uint64((width + 1) // 2)
    for factor in (0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15):
        value = (value ^ (value >> half)) * np.uint64(pow(factor, -1, 1 << 64)) & mask
    return value ^ (value >> half)


def pack(ids: list[np.ndarray], layout: Layout) -> list[np.ndarray]:
    """Three ids as one spread number, or as two of which the first is spread and depends on the second."""
    a, b, c = (x.astype(np.uint64) for x in ids)
    if not layout.wide:
        bits = np.uint64(layout.bits)
        return [spread(a << (bits + bits) | b << bits | c, layout.width)]
    low = b << np.uint64(32) | c
    return [spread((a + mix(low)) & np.uint64((1 << _WIDE) - 1), _WIDE), low]


def unpack(keys: list[np.ndarray], layout: Layout) -> list[np.ndarray]:
    if not layout.wide:
        bits, mask = np.uint64(layout.bits), np.uint64((1 << layout.bits) - 1)
        value = gather(keys[0], layout.width)
        return [value >> (bits + bits), value >> bits & mask, value & mask]
    low = keys[1]
    a = (gather(keys[0], _WIDE) - mix(low)) & np.uint64((1 << _WIDE) - 1)
    return [a, low >> np.uint64(32), low & np.uint64((1 << 32) - 1)]


def merge(runs: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted runs of numbers with counts as one; counts of equal numbers are added. A stable sort takes runs as they are."""
    keys = [np.concatenate(k) for k in zip(*(r[0] for r in runs), strict=True)]
    counts = np.concatenate([r[1] for r in runs])
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    keys, counts = [k[order] for k in keys], counts[order]
    new = np.ones(len(counts), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(new)
    return [k[first] for k in keys], np.add.reduceat(counts, first) if len(first) else counts


def encode(keys: list[np.ndarray], counts: np.ndarray, width: int) -> dict[str, object]:
    """A filter of sorted numbers of which the first has ``width`` bits: as many quotients as entries, by the power of two."""
    n = len(counts)
    quotient_bits = min(max(n.bit_length() - 1, 0), width)
    left = width - quotient_bits
    ends = np.cumsum(np.bincount((keys[0] >> np.uint64(left)).astype(np.int64), minlength=1 << quotient_bits)) + np.arange(1 << quotient_bits)
    unary = np.zeros(n + (1 << quotient_bits), np.uint8)
    unary[ends] = 1
    rest = keys[0] & np.uint64((1 << left) - 1)
    held = np.minimum(counts, 255).astype(np.uint8)
    return {
        "size": n,
        "runs": np.packbits(unary).tobytes(),
        "remainders": rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-left // 8)].tobytes(),
        "further": keys[1].tobytes() if len(keys) > 1 else b"",
        "counters": held.tobytes(),
        "overflow": counts[held == 255].astype(np.int64).tobytes(),
    }


def decode(filter_: dict[str, object], width: int, wide: bool) -> tuple[list[np.ndarray], np.ndarray]:
    n = filter_["size"]
    quotient_bits = min(max(n.bit_length() - 1, 0), width)
    left = width - quotient_bits
    unary = np.unpackbits(np.frombuffer(filter_["runs"], np.uint8))[: n + (1 << quotient_bits)]
    quotient = np.cumsum(unary, dtype=np.uint64)[unary == 0]
    rest = np.zeros((n, 8), np.uint8)
    rest[:, : -(-left // 8)] = np.frombuffer(filter_["remainders"], np.uint8).reshape(n, -(-left // 8))
    counts = np.frombuffer(filter_["counters"], np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(filter_["overflow"], np.int64)
    keys = [quotient << np.uint64(left) | rest.view("<u8").reshape(-1)]
    return [*keys, np.frombuffer(filter_["further"], np.uint64)] if wide else keys, counts


_FILTER = "slice long, size long, runs binary, remainders binary, further binary, counters binary, overflow binary"
_FIELDS = pa.schema([("slice", pa.int64()), ("size", pa.int64()), *[(f, pa.binary()) for f in ("runs", "remainders", "further", "counters", "overflow")]])


class _Counter:
    """n-grams of one task, as sorted runs that are merged before they are written as filters."""

    def __init__(self, layout: Layout) -> None:
        self.layout, self.runs, self.held = layout, [], 0

    def add(self, ids: np.ndarray, piece: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Counts all pairs and triples of neighbours of one piece; an id of 0 is none."""
        two = (ids[:-1] > 0) & (ids[1:] > 0) & (piece[:-1] == piece[1:])
        three = two[:-1] & two[1:]
        at2, at3 = np.flatnonzero(two), np.flatnonzero(three)
        third = np.concatenate([np.zeros(len(at2), np.int64), ids[at3 + 2]])
        at = np.concatenate([at2, at3])
        if len(at):
            keys = pack([ids[at], ids[at + 1], third], self.layout)
            keys[0] = keys[0].copy()
            if not self.layout.wide:
                keys[0].sort()
            self.runs.append(merge([(keys, np.ones(len(at), np.int64))]))
            self.held += len(self.runs[-1][1])
        if self.held >= _GATHERED:
            self.runs = [merge(self.runs)]
            self.held = len(self.runs[0][1])
            if self.held >= _GATHERED // 2:
                yield from self.written()
            give_back()

    def written(self) -> Iterator[pa.RecordBatch]:
        if not self.runs:
            return
        keys, counts = merge(self.runs)
        self.runs, self.held = [], 0
        left = np.uint64(self.layout.width - self.layout.slice_bits)
        of = keys[0] >> left
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        cuts, inside = [*first.tolist(), len(of)], keys[0] & ((np.uint64(1) << left) - np.uint64(1))
        rows = []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            rows.append({"slice": int(of[lo]), **encode([inside[lo:hi], *(k[lo:hi] for k in keys[1:])], counts[lo:hi], int(left))})
        yield pa.RecordBatch.from_pylist(rows, schema=_FIELDS)


def _merged(layout: Layout, least: int) -> Callable[[pa.Table], pa.Table]:
    """Of the filters of one slice: the n-grams that are frequent enough, as ids."""

    def run(table: pa.Table) -> pa.Table:
        left, of = layout.width - layout.slice_bits, np.uint64(table.column("slice")[0].as_py())
        held = [decode(f, left, layout.wide) for f in (table.slice(i, 1).to_pylist()[0] for i in range(table.num_rows))]
        keys, counts = merge(held)
        keep = counts >= least
        keys = [k[keep] for k in keys]
        keys[0] = keys[0] | of << np.uint64(left)
        a, b, c = (x.astype(np.int64) for x in unpack(keys, layout))
        return pa.table({"a": a, "b": b, "c": c, "n": counts[keep]})

    return run


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each slice of rows (lang, text): the distinct pairs of language and word as a table, and of each word its place in
    that and its piece."""
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        langs = batch.column(0).cast(pa.large_string()).fill_null("und").dictionary_encode()
        code = langs.indices.to_numpy().astype(np.int64)
        for lo, hi in slices(offsets):
            part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            distinct, word, begin, rows = words(part, at, _GAP)
            if not len(word):
                continue
            row = np.repeat(np.arange(hi - lo), np.diff(rows))
            pairs, place = np.unique(code[lo:hi][row] * len(distinct) + word, return_inverse=True)
            keys = pa.table({"lang": langs.dictionary.take(pairs // len(distinct)), "word": distinct.take(pairs % len(distinct))})
            # a piece ends at a break and at the end of a row
            yield keys, place, np.cumsum(_BREAK[part])[begin] + row


def word_counts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """``lang`` ('und' for null), ``word`` and ``n``, its occurrences. Each task adds up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for keys, place, _ in _tables(batches):
            held.append(keys.append_column("n", pa.array(np.bincount(place, minlength=keys.num_rows))))
            size += keys.num_rows
            if size >= _TABLE:
                held = [_added(held)]
                size = held[0].num_rows
                if size >= _TABLE // 2:
                    yield from held[0].to_batches()
                    held, size = [], 0
        if held:
            yield from _added(held).to_batches()

    found = docs.select(F.col(lang).cast("string"), text).mapInArrow(tidy(run), "lang string, word string, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _added(tables: list[pa.Table]) -> pa.Table:
    kind = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
    found = pa.concat_tables(t.cast(kind) for t in tables).group_by(["lang", "word"]).aggregate([("n", "sum")])
    return found.rename_columns(kind.names).cast(kind)


def _key(lang: pa.Array, word: pa.Array) -> pa.Array:
    """A word of a language as one string: no word holds a space."""
    return pc.binary_join_element_wise(lang.cast(pa.large_string()), word.cast(pa.large_string()), pa.scalar(" ", pa.large_string()))


def _filters(docs: DataFrame, vocabulary: DataFrame, layout: Layout, lang: str, text: str, fits: bool) -> DataFrame:
    """Filters of all n-grams of known words. A vocabulary of bounded size goes along with the tasks; of a larger one each
    shard of the texts gets the words that it holds."""
    own = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))

    def counted(tables: Iterator, known: pa.Array, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        counter, options = _Counter(layout), pc.SetLookupOptions(value_set=known)
        for group in _grouped(tables):
            keys = pa.concat_arrays([_key(t.column("lang").combine_chunks(), t.column("word").combine_chunks()) for t, _, _ in group])
            found = pc.index_in(keys, options=options)
            mine, begin = np.where(found.is_valid(), ids[found.fill_null(0)] if len(ids) else 0, 0), 0
            for table, place, piece in group:
                yield from counter.add(mine[begin : begin + table.num_rows][place], piece)
                begin += table.num_rows
        yield from counter.written()

    if fits:
        table = vocabulary.select("lang", "word", "id").toArrow()
        known = _key(table.column("lang").combine_chunks(), table.column("word").combine_chunks())
        ids = table.column("id").to_numpy().astype(np.int64)
        return own.mapInArrow(tidy(lambda batches: counted(_tables(batches), known, ids)), _FILTER)

    n = max(1, (own.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0) // _SHARD)
    sharded = materialize(own.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(n))))

    def distinct(table: pa.Table) -> pa.Table:
        found = [k for k, _, _ in _tables(table.select(["lang", "text"]).to_batches())]
        kind = pa.schema([("lang", pa.string()), ("word", pa.string())])
        held = pa.concat_tables([kind.empty_table(), *(t.cast(kind) for t in found)]).group_by(["lang", "word"]).aggregate([])
        return held.append_column("shard", pa.array(np.full(held.num_rows, table.column("shard")[0].as_py())))

    def shard(texts: pa.Table, met: pa.Table) -> pa.Table:
        known = _key(met.column("lang").combine_chunks(), met.column("word").combine_chunks())
        found = counted(_tables(texts.select(["lang", "text"]).to_batches()), known, met.column("id").to_numpy().astype(np.int64))
        return pa.Table.from_batches(found, schema=_FIELDS)

    met = sharded.groupBy("shard").applyInArrow(tidy_group(distinct), "lang string, word string, shard long")
    local = met.join(vocabulary.select("lang", "word", "id"), ["lang", "word"]).select("shard", "lang", "word", "id")
    return sharded.groupBy("shard").cogroup(local.groupBy("shard")).applyInArrow(tidy_groups(shard), _FILTER)


def _grouped(tables: Iterator, most: int = 1 << 17) -> Iterator[list]:
    """Tables in groups of about so many rows, as a look-up prepares the whole vocabulary each time."""
    held, size = [], 0
    for t in tables:
        held.append(t)
        size += t[0].num_rows + len(t[1]) // 8
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


@dataclass
class Counted:
    """Written tables: all words with their number, those with an id, and the frequent n-grams of ids (``c`` 0: a pair)."""

    words: DataFrame
    vocabulary: DataFrame
    grams: DataFrame


def count(docs: DataFrame, *, lang: str = "lang", text: str = "text", least: int = 10) -> Counted:
    """All words of each language, and its phrases of two and three words that come ``least`` times or more."""
    all_words = materialize(word_counts(docs, lang, text))
    frequent = ranked(all_words.where(F.col("n") >= least), ["lang", "word"])
    vocabulary = materialize(frequent.rows("rank").withColumn("id", F.col("rank") + 1).drop("rank"))
    frequent.drop()
    size = vocabulary.agg(F.sum(F.octet_length("lang") + F.octet_length("word") + 1).alias("n")).first()["n"] or 0
    n = all_words.agg(F.sum("n").alias("n")).first()["n"] or 0
    bits = max(1, frequent.total.bit_length())
    if bits > _WIDE:
        raise ValueError(f"{frequent.total} frequent words have no ids of {_WIDE} bits; ask for phrases that come more often")
    wanted = max(partitions(docs.sparkSession), 2 * n // _SLICE)
    layout = Layout(bits, 0)
    layout = Layout(bits, min((wanted - 1).bit_length(), layout.width - 1))
    filters = _filters(docs, vocabulary, layout, lang, text, frequent.total < _WORDS and size <= _BYTES)
    grams = filters.groupBy("slice").applyInArrow(tidy_group(_merged(layout, least)), "a long, b long, c long, n long")
    return Counted(all_words, vocabulary, materialize(grams))


def _score(a: str, left: str, right: str) -> Column:
    wide = lambda c: f"CAST({c} AS DECIMAL(38, 0))"
    return F.expr(f"(1000000 * {wide(a)} * {wide(a)}) div ({wide(left)} * {wide(right)})")


def collocations(
    docs: DataFrame, *, lang: str = "lang", text: str = "text", least: int = 10, inside_percent: int = 50, top: int = 2000
) -> DataFrame:
    """Each language's ``top`` phrases of two or three words: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Texts fall into pieces at ``.,;:!?`` and line ends, these into words at spaces and tabs, A-Z lower-cased. A phrase's
    score is floor(10**6 * a * a / (l * r)) for the cut where that is lowest, the first of equal ones; l and r count what
    stands before and after the cut, a the phrase. Phrases that come fewer than ``least`` times aren't scored; one of two
    words is left out if a phrase of three that holds it comes ``inside_percent`` of its times or more. Ties go to the more
    frequent, then to the first by bytes.

    Null texts and empty ones hold nothing, a null language is 'und' (together with a language of that name), repeated rows
    count as often as they stand there, texts of any length count whole, no other column is read. A table without phrases,
    or without rows, gives no rows.
    """
    found = count(docs, lang=lang, text=text, least=least)
    total = found.words.groupBy("lang").agg(F.sum("n").alias("total"))
    word = lambda p: found.vocabulary.select(*[F.col(c).alias(f"{p}_{c}") for c in ("id", "lang", "word", "n")])
    pairs = found.grams.where("c = 0").select("a", "b", "n")
    triples = found.grams.where("c > 0")
    first, second = pairs.withColumnRenamed("n", "front"), pairs.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("n").alias("back"))
    longer = triples.groupBy("a", "b").agg(F.max("n").alias("n_front")), triples.groupBy(F.col("b").alias("a"), F.col("c").alias("b")).agg(
        F.max("n").alias("n_back")
    )
    alone = pairs.join(longer[0], ["a", "b"], "left").join(longer[1], ["a", "b"], "left").where(
        100 * F.greatest(F.coalesce("n_front", F.lit(0)), F.coalesce("n_back", F.lit(0))) < inside_percent * F.col("n")
    )
    two = alone.join(word("x"), F.col("a") == F.col("x_id")).join(word("y"), F.col("b") == F.col("y_id")).select(
        F.col("x_lang").alias("lang"),
        F.concat_ws(" ", "x_word", "y_word").alias("phrase"),
        F.col("n").alias("a"),
        F.col("x_n").alias("l"),
        F.col("y_n").alias("r"),
        _score("n", "x_n", "y_n").alias("score"),
    )
    three = triples.join(first, ["a", "b"]).join(second, ["b", "c"])
    for p, c in (("x", "a"), ("y", "b"), ("z", "c")):
        three = three.join(word(p), F.col(c) == F.col(f"{p}_id"))
    cuts = three.withColumn("one", _score("n", "x_n", "back")).withColumn("two", _score("n", "front", "z_n"))
    pick = lambda x, y: F.when(F.col("one") <= F.col("two"), F.col(x)).otherwise(F.col(y))
    three = cuts.select(
        F.col("x_lang").alias("lang"),
        F.concat_ws(" ", "x_word", "y_word", "z_word").alias("phrase"),
        F.col("n").alias("a"),
        pick("x_n", "front").alias("l"),
        pick("back", "z_n").alias("r"),
        pick("one", "two").alias("score"),
    )
    # each task keeps its best of a language, so that these alone meet in one
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = two.union(three).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
