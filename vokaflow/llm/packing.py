"""Best-fit packing of documents into sequences of a fixed token capacity.

Best-fit decreasing looks at nothing but lengths, and lengths are whole numbers up to the
capacity. So the packing itself runs over the histogram of piece lengths, at most
``capacity`` counts whatever the corpus size: bins with equal room form intervals of sequence
numbers, a segment tree over remaining capacities finds the tightest open interval in
logarithmic time, and a run of equal pieces is placed at once. The outcome is exactly that of
placing the pieces one by one in decreasing order. Executors then turn (length, rank among equal
lengths) into (sequence, offset).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import TEXTS_PER_BATCH, text_or_empty, written

CAPACITY, EOS = 1024, 2
#: Words and pieces of words whose ids a worker remembers; on overflow it starts anew.
CACHED_WORDS, CACHED_PIECES = 550_000, 120_000
#: Texts with any other character are encoded whole, so two Unicode tables never have to agree.
_ODD = re.compile("[^\t\n\x20-\x7e -ɏ‐-‧€]")

#: White space next to white space, or other than a space and a newline: pieces may then cross a space.
_PAIRS = ("  ", "\n\n", " \n", "\n ", "\t", "\xa0")


class CapacityTree:
    """A segment tree over remaining capacities 0..size; a leaf is set while bins with that room
    are open."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.set_ = [False] * (2 * self.leaves)

    def put(self, capacity: int, there: bool) -> None:
        at = self.leaves + capacity
        self.set_[at] = there
        while at > 1:
            at //= 2
            self.set_[at] = self.set_[2 * at] or self.set_[2 * at + 1]

    def tightest(self, need: int) -> int | None:
        """The least set capacity that is need or more."""
        at = self.leaves + need
        if self.set_[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.set_[at + 1]:
                at += 1
                break
            at //= 2
        else:
            return None
        while at < self.leaves:
            at = 2 * at + (not self.set_[2 * at])
        return at - self.leaves


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Places counts[length] pieces of each length.

    Returns the runs, one row each of (length, first rank, pieces per sequence, first sequence,
    offset), by length and rank, and the number of sequences. Rank r of a run goes to sequence
    first + (r - first rank) // per, at offset + (r - first rank) % per * length.
    """
    tree, room, runs, opened = CapacityTree(capacity), {}, [], 0

    def push(left: int, start: int, n: int) -> None:
        if n and left:
            room.setdefault(left, []).append((start, n))
            tree.put(left, True)

    for length in range(capacity, 0, -1):
        todo, rank = counts.get(length, 0), 0
        while todo:
            left = tree.tightest(length)
            if left is None:
                left, n = capacity, -(-todo // (capacity // length))
                start, opened = opened, opened + n
            else:
                start, n = room[left].pop()
                if not room[left]:
                    tree.put(left, False)
            per = left // length
            full = min(n, todo // per)
            if full:
                runs.append((length, rank, per, start, capacity - left))
                push(left - per * length, start, full)
                rank, todo, start, n = rank + full * per, todo - full * per, start + full, n - full
            if n and 0 < todo < per:
                runs.append((length, rank, todo, start, capacity - left))
                push(left - todo * length, start, 1)
                rank, todo, start, n = rank + todo, 0, start + 1, n - 1
            push(left, start, n)
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 5), opened


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level BPE names each byte: printable Latin-1 as it is, the other
    bytes by the letters from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in plain else next(others)) for b in range(256)}


@lru_cache(maxsize=4)
def token_bytes(path: str) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian unsigned 32-bit numbers.

    A byte-level BPE never merges across the pieces of its split pattern, so a worker looks each
    piece up and asks the tokenizer's model only for new ones. Where white space only comes
    singly, no piece crosses the place before a space, so whole space-led words are looked up.
    """
    import public_tokenizers
    import regex
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    pieces = regex.compile(public_tokenizers.PATTERN).findall
    letters, model = _byte_letters(), tokenizer.model

    class Pieces(dict):
        def __missing__(self, piece: str) -> bytes:
            if len(self) >= CACHED_PIECES:
                self.clear()
            named = piece.encode().decode("latin-1").translate(letters)
            ids = self[piece] = pack(f"<{len(found := model.tokenize(named))}I", *[t.id for t in found])
            return ids

    class Words(dict):
        def __missing__(self, word: str) -> bytes:
            if len(self) >= CACHED_WORDS:
                self.clear()
            if word.isalpha():
                ids = of_piece(" " + word)
            elif word[-1:] in (".", ",") and word[:-1].isalpha():
                ids = of_piece(" " + word[:-1]) + of_piece(word[-1])
            else:
                ids = b"".join(map(of_piece, pieces(" " + word)))
            self[word] = ids
            return ids

    of_piece, of_word = Pieces().__getitem__, Words().__getitem__

    def of_line(line: str) -> bytes:
        head, space, rest = line.partition(" ")
        start = b"".join(map(of_piece, pieces(head)))
        return start + b"".join(map(of_word, rest.split(" "))) if space else start

    def encode(text: str) -> bytes:
        lines = text.split("\n")
        if not all(map(str.isprintable, lines)) if text.isascii() else _ODD.search(text):
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if any(pair in text for pair in _PAIRS):
            return b"".join(map(of_piece, pieces(text)))
        return of_piece("\n").join(map(of_line, lines))

    return encode


def _cut(path: str, capacity: int, eos: int, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = token_bytes(path), np.array([eos], dtype="<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = ids_of(text.as_py()) + end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    own = ids[4 * a : 4 * b]
                    rows.append((key, piece, a, b - a, zlib.crc32(own), own if with_ids else None))
                size += len(ids) if with_ids else 0
                if len(rows) >= 20_000 or size > 8_000_000:
                    yield _arrow(rows, batch.schema.field(0).type, with_ids)
                    rows, size = [], 0
            yield _arrow(rows, batch.schema.field(0).type, with_ids)

    return run


def _arrow(rows: list[tuple], key: pa.DataType, with_ids: bool) -> pa.RecordBatch:
    kinds = (("key", key), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary()))
    columns = list(zip(*rows, strict=True)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns[: 5 + with_ids], kinds, strict=False)], [n for n, _ in kinds][: 5 + with_ids])


def cut_documents(docs: DataFrame, *, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, eos: int = EOS, with_ids: bool = False) -> DataFrame:
    """One row per piece: the id column, piece, start, length, ids_crc32 and, if asked for, ids.

    A null text is an empty one; every document ends in ``eos``, so none is without a piece.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    slim = docs.select(F.col(id_column).alias("key"), text_or_empty(text_column).alias("text"))
    return slim.mapInArrow(_cut(tokenizer, capacity, eos, with_ids), schema).withColumnRenamed("key", id_column)


def pack_pieces(pieces: DataFrame, *, id_column: str = "doc_id", capacity: int = CAPACITY, number: str | None = None) -> DataFrame:
    """Adds sequence_id and offset to rows that carry a length from 1 to ``capacity``.

    pieces is read twice; pass a written table. Equal lengths are ranked within about
    sqrt(rows) cells of a hash, so no task holds all pieces of one length. Repeated rows get places of their own;
    where ``number`` names a column of row numbers, they spread over the cells too. An empty table stays empty.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    runs, _ = best_fit_decreasing(counts, capacity)
    salts = max(1, int(max(counts.values(), default=1) ** 0.5))
    salted = pieces.withColumn("_cell", F.pmod(F.xxhash64(id_column, "piece", *([number] if number else [])), F.lit(salts)).cast("int"))
    cells = salted.groupBy("length", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = cells.select("length", "_cell", (F.sum("_n").over(Window.partitionBy("length").orderBy("_cell")) - F.col("_n")).alias("_before"))
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_cell").orderBy(id_column, "piece", "start", "ids_crc32")) - 1)
    joined = ranked.join(before, ["length", "_cell"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    # One sorted axis: a length's ranks lie above those of all shorter lengths.
    base = np.concatenate([[0], np.cumsum([counts.get(k, 0) for k in range(capacity + 1)])])
    starts = base[runs[:, 0]] + runs[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, at = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        run = np.searchsorted(starts, base[size] + at, side="right") - 1
        nth = at - runs[run, 1]
        return pd.DataFrame({"sequence_id": runs[run, 3] + nth // runs[run, 2], "offset": runs[run, 4] + nth % runs[run, 2] * size})

    return joined.withColumn("_place", place("length", "_rank")).select(*pieces.columns, "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, *, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, eos: int = EOS, with_ids: bool = False) -> DataFrame:
    """Cuts and packs all documents.

    One row per piece: the id column, piece, start, length, ids_crc32, (ids,) sequence_id, offset.
    Null texts count as empty and take one place for ``eos``; repeated rows are packed each on
    their own; other columns, whatever their names, are not read; no rows give no rows.
    """
    cut = cut_documents(docs, tokenizer=tokenizer, id_column=id_column, text_column=text_column, capacity=capacity, eos=eos, with_ids=with_ids)
    pieces = written(cut.withColumn("_number", F.monotonically_increasing_id()), "pieces", TEXTS_PER_BATCH)
    return pack_pieces(pieces, id_column=id_column, capacity=capacity, number="_number").drop("_number")
