"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the vocabulary goes on after a marked word has begun with letters, i.e. no piece has a white-space mark
behind another character. A text is therefore a row of chunks, each a run of marks and the characters up to the next
mark, that are segmented independently of each other. Every task keeps a table of the distinct chunks it has met,
segments each of them once with the library, and joins ids and decoded characters back by position.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import tidy

_CHUNK = re.compile(" +[^ ]*")
_MARK = "▁"


class ChunkTable:
    """Distinct chunks with their ids and decoded characters; cleared when it holds ``limit`` chunks (bounded memory)."""

    def __init__(self, model_file: str, limit: int):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        for i in range(self.model.vocab_size()):
            if _MARK in self.model.id_to_piece(i).lstrip(_MARK):
                raise ValueError(f"piece {i} crosses a white-space mark; chunks can't be segmented alone")
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)  # of all chunks, one after the other
        self.ends = [0]
        self.decoded: list[str] = []

    def add(self, chunks: list[str]) -> None:
        # the library puts one mark in front of a text, so a chunk is encoded without its first; nothing is left of a lone mark
        found = self.model.encode([c[1:] for c in chunks], num_threads=1)
        found = [ids or [self.model.piece_to_id(_MARK)] for ids in found]
        self.decoded += [" " + text for text in self.model.decode(found, num_threads=1)]
        self.index.update(zip(chunks, range(len(self.index), len(self.index) + len(chunks)), strict=True))
        end = self.ends[-1]
        new = np.fromiter(chain.from_iterable(found), np.int32)
        if end + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids[:end], np.zeros(end + 2 * len(new), np.int32)])
        self.ids[end : end + len(new)] = new
        self.ends += (end + np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))).tolist()

    def lookup(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """All ids, the number of ids of each text, and each decoded text."""
        if len(self.index) > self.limit:
            self.clear()
        rows = [_CHUNK.findall(" " + t.replace(_MARK, " ")) if t else [] for t in texts]
        if new := set().union(*rows).difference(self.index):
            self.add([*new])
        at = [[*map(self.index.__getitem__, row)] for row in rows]
        flat = np.fromiter(chain.from_iterable(at), np.int64, sum(map(len, at)))
        ends = np.asarray(self.ends)
        sizes = ends[flat + 1] - ends[flat]
        before = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.arange(before[-1]) + np.repeat(ends[flat] - before[:-1], sizes)]
        counts = np.diff(before[np.concatenate([[0], np.cumsum([len(row) for row in at], dtype=np.int64)])])
        return ids, counts, ["".join(map(self.decoded.__getitem__, row))[1:] for row in at]


def encode_decode(
    docs: DataFrame, model_file: str, *, key: str = "doc_id", text: str = "text", table_chunks: int = 300_000, rows_at_once: int = 256
) -> DataFrame:
    """``key``, ``ids`` (array of int, as the library's encode without begin or end ids) and ``decoded`` (its decode).

    Null text counts as empty: no ids, decoded "". Texts of any length go through whole; equal texts and repeated rows
    give a row each; an empty table gives no rows; other columns are not read.
    """
    frame = docs.select(key, text)
    kind = frame.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            table = table or ChunkTable(model_file, table_chunks)
            for start in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(start, rows_at_once)
                ids, counts, decoded = table.lookup([t or "" for t in part.column(1).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), pa.array(decoded, pa.string())],
                    names=[key, "ids", "decoded"],
                )

    return frame.mapInArrow(tidy(run), f"`{key}` {kind}, ids array<int>, decoded string")
