"""Packing: token sequences of near-equal fill by Karmarkar-Karp multiway differencing.

Every document becomes its token ids and an end id. Windows of ``capacity`` ids are cut off from
its start and are full sequences of their own. What is left is cut into pieces of at most
``piece_cap`` ids, and the pieces of ``group`` documents at a time are spread over windows by
differencing; the number of windows starts at the least and rises whenever one exceeds the capacity.

A task packs the documents it reads, so nothing is shuffled and a lost task is simply run again.
Sequence ids are ``partition << 40 | running number``.

Defined cases: a null text counts as empty (the end id alone); an empty table gives no rows;
repeated rows are packed each by itself; a null doc_id is kept as null; pieces of equal length are
told apart by checksum and place; very long texts are encoded whole, one text at a time; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import common
from gridloom.llm.bpe import loaded
from gridloom.llm.differencing import near_equal_windows

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack_group(pieces: list[tuple], capacity: int, first: int) -> tuple[list[tuple], int]:
    """Rows of one group's pieces (each piece: doc_id, start, length, crc, doc_tokens) and the next sequence number."""
    rows, small = [], []
    for piece in pieces:
        if piece[2] == capacity:
            rows.append((*piece, first, 0))
            first += 1
        else:
            small.append(piece)
    small.sort(key=lambda p: (-p[2], p[3], p[1]))
    for window in near_equal_windows([p[2] for p in small], capacity):
        offset = 0
        for i in sorted(window):
            rows.append((*small[i], first, offset))
            offset += small[i][2]
        first += 1
    return rows, first


def cut(doc_id, ids: bytes, capacity: int, piece_cap: int) -> list[tuple]:
    total, start, pieces = len(ids) // 4, 0, []
    while start < total:
        left = total - start
        length = capacity if left >= capacity else min(left, piece_cap)
        pieces.append((doc_id, start, length, zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)]), total))
        start += length
    return pieces


def pack(docs: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str, capacity: int = 1024, end_id: int = 0, piece_cap: int = 256, group: int = 512) -> DataFrame:
    """One row a piece: its place in the document, its checksum, its sequence and offset there."""
    common.ship(docs.sparkSession)
    types = pa.schema([(c, pa.int64()) for c in COLUMNS])
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode_all = loaded(tokenizer_path, ranks_path, pattern).encode_all
        following, held, waiting = TaskContext.get().partitionId() << 40, 0, []

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=types)

        for part in common.slices(batches):
            texts = [t or "" for t in part.column(1).to_pylist()]
            for doc_id, ids in zip(part.column(0).to_pylist(), encode_all(texts), strict=True):
                waiting += cut(doc_id, ids + end, capacity, piece_cap)
                held += 1
                if held == group:
                    rows, following = pack_group(waiting, capacity, following)
                    yield out(rows)
                    held, waiting = 0, []
        if waiting:
            yield out(pack_group(waiting, capacity, following)[0])
        common.release()

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, SCHEMA)


def tokenizer_files() -> tuple[str, str, str]:
    import public_tokenizers as public

    return public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.documents(spark, sf_dir), *tokenizer_files())


def padding(lengths: np.ndarray, capacity: int) -> int:
    """Padding ids of sequences: up to the capacity, none at a power of two."""
    lengths = np.asarray(lengths)
    return int(np.where((lengths & (lengths - 1)) == 0, 0, capacity - lengths).sum())
