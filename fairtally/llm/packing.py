"""Packing of tokenised documents into fixed-length sequences, certified by lower bounds."""

from __future__ import annotations

import json
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairtally.llm.common import slices, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 1024
END_ID = 2
GROUP_ITEMS = 20_000
ROUNDS = 4
CACHE_PIECES = 200_000
PART_BYTES = 4 << 20

_loaded: dict[str, tiktoken.Encoding] = {}


def default_tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizers file, whose merges are in the order of their ids."""
    if path not in _loaded:
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        # Byte-level files write each byte as one printable character.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if all(c in byte for c in token) and token != "<|endoftext|>"}
        _loaded[path] = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


class _Boundary(Exception):
    """The text can't be cut at this blank."""


class PieceIds(dict):
    """Ids (as little-endian bytes) of a blank and the piece after it; starts anew when it holds many.

    The pattern lets a single blank go with what follows and never looks back, so a text whose
    pieces between blanks neither begin nor end with white space is encoded piece by piece.
    """

    def __init__(self, coder: tiktoken.Encoding):
        super().__init__()
        self.coder = coder

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Boundary
        if len(self) >= CACHE_PIECES:
            self.clear()
        value = self[piece] = np.array(self.coder.encode_ordinary(" " + piece), "<u4").tobytes()
        return value


def text_ids(text: str | None, coder: tiktoken.Encoding, cache: PieceIds) -> bytes:
    """All ids of a text and the end id, as little-endian unsigned 32-bit numbers."""
    if not text:
        return np.array([END_ID], "<u4").tobytes()
    first, *rest = text.split(" ")
    try:
        if not first or first[0].isspace() or first[-1].isspace():
            raise _Boundary
        start = np.array(coder.encode_ordinary(first), "<u4").tobytes()
        body = start + b"".join(map(cache.__getitem__, rest))
    except _Boundary:
        body = np.array(coder.encode_ordinary(text), "<u4").tobytes()
    return body + np.array([END_ID], "<u4").tobytes()


def _cut(path: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(path)
        cache = PieceIds(coder)
        for batch in batches:
            for part in slices(batch, "text", PART_BYTES):
                rows: list[tuple] = []
                ids: list[np.ndarray] = []
                for i, value in enumerate(part.column("text")):
                    data = text_ids(value.as_py(), coder, cache)
                    n = len(data) // 4
                    # Whatever is over goes first, so that all other pieces are full.
                    edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(edges, edges[1:])):
                        rows.append((i, k, a, b - a, zlib.crc32(data[4 * a : 4 * b])))
                        if with_ids:
                            ids.append(np.frombuffer(data[4 * a : 4 * b], "<i4"))
                if not rows:
                    continue
                at, piece, start, length, crc = zip(*rows)
                columns = {
                    "doc_id": part.column("doc_id").take(pa.array(at, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
                yield pa.record_batch(columns)

    return run


def tokenized_pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece of each document's ids and the end id; null text is empty."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    return docs.mapInArrow(_cut(tokenizer, capacity, with_ids), schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the fill of each bin. ``lengths`` is in decreasing order."""
    space: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_mask, fill = 0, []
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        fitting = open_mask >> size
        if fitting:  # the least space that suffices
            left = size + (fitting & -fitting).bit_length() - 1
            b = space[left].pop()
            if not space[left]:
                open_mask ^= 1 << left
        else:
            b, left = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        if left > size:
            if not space[left - size]:
                open_mask |= 1 << (left - size)
            space[left - size].append(b)
    return bins, offsets, np.array(fill, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best bound of two families of dual feasible functions; no packing has fewer bins."""
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    below = np.concatenate([[0], np.cumsum(count * size)])  # total of sizes under the index
    fewer = np.concatenate([[0], np.cumsum(count)])
    e = np.arange(0, capacity // 2 + 1)
    # Sizes above capacity - e count as whole bins, those under e as nothing.
    whole = fewer[-1] - fewer[capacity - e + 1]
    rest = below[capacity - e + 1] - below[e]
    best = int((whole + -(-rest // capacity)).max())
    for k in range(1, 31):
        # x stays where (k + 1) x is a multiple of the capacity, else floor((k + 1) x / capacity) / k.
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, k * scaled, (k + 1) * capacity * (scaled // capacity))
        best = max(best, int(-(-(value * count).sum() // (k * (k + 1) * capacity))))
    return best


def _pack_group(capacity: int, final: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "uid"], ascending=[False, True], ignore_index=True)
        bins, offsets, fill = best_fit_decreasing(pdf["length"].to_numpy(), capacity)
        certified = len(fill) == lower_bound(pdf["length"].to_numpy(), capacity)
        closed = np.full(len(fill), True)
        if not final:
            # A certified group gives only its emptiest bin to the exchange, any other all that isn't full.
            closed = fill == capacity if not certified else np.arange(len(fill)) != fill.argmin()
            closed |= fill == capacity
        return pd.DataFrame(
            {"uid": pdf["uid"], "length": pdf["length"], "grp": pdf["grp"], "bin": bins, "place": offsets, "closed": closed[bins]}
        )

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, rounds: int = ROUNDS) -> DataFrame:
    """Adds sequence_id and offset to pieces with ``length`` (1 to ``capacity``), using few sequences.

    Full pieces are sequences of their own. The others are dealt into groups of about
    ``group_items``; each group is packed by best fit decreasing and compared with its lower
    bound. What certified groups leave over and all unfilled bins of other groups are dealt anew
    into fewer groups and packed again, at most ``rounds`` times. A group never grows with the
    corpus, and repeated rows are pieces of their own.
    """
    rows = stored(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    items = rows.where(F.col("length") < capacity).select("uid", "length")
    placed = rows.where(F.col("length") >= capacity).select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = items.count()
    for turn in range(rounds):
        if not left:
            break
        groups = -(-left // group_items)
        final = groups == 1 or turn == rounds - 1
        dealt = items.withColumn("grp", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(groups)))
        packed = dealt.repartition(min(groups, 100_000), "grp").groupBy("grp").applyInPandas(
            _pack_group(capacity, final), "uid bigint, length bigint, grp bigint, bin bigint, place bigint, closed boolean"
        )
        packed = stored(packed, f"packed-{turn}")
        # Bins have numbers below zero, so they never meet those of full pieces.
        number = -1 - ((F.lit(turn).cast("long") * 2**30 + F.col("grp")) * 2**30 + F.col("bin"))
        placed = placed.union(packed.where("closed").select("uid", number.alias("sequence_id"), F.col("place").alias("offset")))
        items = packed.where("NOT closed").select("uid", "length")
        left = items.count()
    return rows.join(placed, "uid").drop("uid")


def pack_documents(documents: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Documents to placed pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Null and empty texts are one piece of the end id; a null doc_id stays null; repeated rows
    are packed each; other columns are not read. An empty table gives no pieces.
    """
    return pack(tokenized_pieces(documents, tokenizer or default_tokenizer(), capacity, with_ids), capacity)
