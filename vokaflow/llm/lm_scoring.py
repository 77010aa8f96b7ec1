"""LM scoring with a log-frequency Bloom filter.

The model is an interpolated word bigram model. Its n-gram counts are not kept as a table: a
count is quantised to a level on a log scale, and the filter holds the pairs (n-gram, 1) to
(n-gram, level). A count is read back by probing level after level until one is missing, so a
false positive can only raise it by a little, and seldom. The filter is sized to its content and built in
segments by n-gram hash on the executors. Up to a bound in bytes it is broadcast to the workers; beyond it
each run of texts asks the segments for its n-grams, and the answers come back to the run.

Counts of all n-grams come from all training text. Map tasks count in numpy and ship sorted arrays of hashes per
hash bucket, not rows; a bucket's arrays meet in one task, and the number of buckets follows the
input. Exact word counts for the base score use a dictionary of the most frequent words, bounded in entries,
and a join for all other words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import TEXTS_PER_BATCH, text_or_empty, written
from .hashing import mix, runs, word_hashes

#: Levels 1, 2, 3, ... hold counts from floor * BASE ** (level - 1). Words (kind 1) are held from one
#: occurrence on; a bigram (kind 2) seen once says no more than its words and is left to them.
FLOORS, BASE = {1: 1, 2: 2}, 2.0
#: The largest filter that is broadcast, the bits that a (n-gram, level) pair gets at least, and its probes.
FILTER_BYTES, BITS_PER_PAIR, PROBES = 4 << 20, 8, 3
#: The most frequent words whose exact counts are broadcast: 16 bytes each.
DICTIONARY_WORDS = 1 << 19
#: The word estimate counts like so many tokens of the context (a Dirichlet prior).
PRIOR = 1000.0
#: Characters of text that a hash bucket answers for, about.
BUCKET_CHARS = 8_000_000
#: Hash arrays in an Arrow batch: about a megabyte, so little is held off the heap.
ARRAYS_PER_BATCH = 16
#: Bytes of a run of texts that asks the segments at once, and its rows in an Arrow batch.
RUN_OF_TEXTS, ASKED_PER_BATCH = 6_000_000, 16
#: The filter knows an n-gram by the top 48 bits of its hash: six bytes to ask for it.
KEY = np.uint64(0xFFFFFFFFFFFF0000)
END = np.uint64(0x8F1BBCDCBFA53E0B)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, tokens of each text): the words with A-Z lower-cased, then an end."""
    hashes, counts = word_hashes(texts, fold=True)
    out = np.full(len(hashes) + len(counts), END)
    text = np.repeat(np.arange(len(counts)), counts)
    out[np.arange(len(hashes)) + text] = hashes
    return out, counts + 1


def run_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes, bigram hashes, tokens of each text) of many texts, worked on in runs that fit a cache."""
    token, pair, count = [], [], []
    for a, b in runs(texts):
        own, counts = tokens(texts.slice(a, b - a))
        token.append(own), pair.append(bigrams(own, counts)), count.append(counts)
    return tuple(np.concatenate(x) if x else np.zeros(0, t) for x, t in ((token, np.uint64), (pair, np.uint64), (count, np.int64)))


def bigrams(token: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each token's hash with the one before it; a text's first token follows an end."""
    before = np.concatenate([[END], token[:-1]])
    before[np.cumsum(counts) - counts] = END
    return mix(mix(before) + token)


def level_of(count: np.ndarray, kind: int) -> np.ndarray:
    floor = FLOORS[kind]
    return np.where(count < floor, 0, 1 + np.floor(np.log(np.maximum(count, 1) / floor) / math.log(BASE) + 1e-9)).astype(np.int64)


def count_of(level: np.ndarray, kind: int) -> np.ndarray:
    """The count that stands for a level, the geometric mean of its least and largest; 0 for none."""
    least = FLOORS[kind] * BASE ** (level - 1.0)
    return np.where(level == 0, 0.0, np.sqrt(least * (least * BASE - 1)))


def _new(sorted_: np.ndarray) -> np.ndarray:
    """Where a sorted array has a value for the first time."""
    return np.concatenate([[True], sorted_[1:] != sorted_[:-1]]) if len(sorted_) else np.zeros(0, bool)


def _distinct(x: np.ndarray) -> np.ndarray:
    """The sorted different values; a plain sort is many times faster than numpy's hash table."""
    x = np.sort(x)
    return x[_new(x)]


def _counted(hashes: np.ndarray, count: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if count is None:
        hashes = np.sort(hashes)
        new = np.flatnonzero(_new(hashes))
        return hashes[new], np.diff(np.append(new, len(hashes)))
    order = np.argsort(hashes)
    hashes = hashes[order]
    new = np.flatnonzero(_new(hashes))
    return hashes[new], np.add.reduceat(count[order], new) if len(hashes) else np.zeros(0, np.int64)


def _pack(hashes: np.ndarray, count: np.ndarray) -> bytes:
    """n-grams seen once as hashes alone, then the others with their counts."""
    once = count == 1
    return np.array([once.sum()], "<i8").tobytes() + hashes[once].tobytes() + hashes[~once].tobytes() + count[~once].astype("<u4").tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    once = int(np.frombuffer(data, "<i8", 1)[0])
    rest = (len(data) - 8 - 8 * once) // 12
    hashes = np.frombuffer(data, "<u8", once + rest, 8)
    return hashes, np.concatenate([np.ones(once, np.int64), np.frombuffer(data, "<u4", rest, 8 + 8 * (once + rest)).astype(np.int64)])


def _count(buckets: int):
    """(text) to (kind, bucket, data): word counts (kind 1) and bigram counts (kind 2)."""

    def flush(kept: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for kind, parts in enumerate(kept, 1):
            hashes, count = _counted(np.concatenate(parts))
            # The top bits choose the bucket, so buckets are runs of the sorted hashes.
            edges = np.searchsorted(hashes, (np.arange(1, buckets, dtype=object) * (1 << 64) // buckets).astype(np.uint64))
            cut = [0, *edges.tolist(), len(hashes)]
            rows = [(k, _pack(hashes[a:b], count[a:b])) for k, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if b > a]
            for i in range(0, len(rows), ARRAYS_PER_BATCH):
                bucket, data = zip(*rows[i : i + ARRAYS_PER_BATCH], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(bucket), pa.int32()), pa.array(bucket, pa.int64()), pa.array(data, pa.binary())], ["kind", "bucket", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [[], []], 0
        for batch in batches:
            for a, b in runs(batch.column(0)):
                token, counts = tokens(batch.column(0).slice(a, b - a))
                kept[0].append(token)
                kept[1].append(bigrams(token, counts))
                size += len(token)
                if size >= 1_500_000:
                    yield from flush(kept)
                    kept, size = [[], []], 0
        if size:
            yield from flush(kept)

    return run


def _merge(key: tuple, rows: pa.Table) -> pa.Table:
    """A bucket's totals: what it has of tokens and n-grams, its levels, and the counts to keep."""
    kind, bucket = (k.as_py() for k in key)
    parts = [_unpack(d.as_py()) for d in rows.column("data")]
    hashes, count = _counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    total, distinct = int(count.sum()), len(hashes)
    pairs, most = int(level_of(count, kind).sum()), int(count.max(initial=0))
    kept = count >= FLOORS[kind]
    hashes, count = hashes[kept], count[kept]
    powers = np.bincount(np.floor(np.log2(count)).astype(np.int64), minlength=63)[:63] if kind == 1 and len(count) else np.zeros(63, np.int64)
    return pa.table({
        "kind": pa.array([kind], pa.int32()), "bucket": pa.array([bucket], pa.int64()), "total": pa.array([total], pa.int64()), "distinct": pa.array([distinct], pa.int64()),
        "pairs": pa.array([pairs], pa.int64()), "most": pa.array([most], pa.int64()), "powers": pa.array([powers.tolist()], pa.list_(pa.int64())), "hashes": pa.array([hashes.tobytes()], pa.binary()), "counts": pa.array([count.astype("<i8").tobytes()], pa.binary()),
    })


def _positions(hashes: np.ndarray, level: int, kind: int, segment: int) -> list[np.ndarray]:
    """The bits of (n-gram, level) within the n-gram's segment of so many bits."""
    x = mix((hashes & KEY) + np.uint64((level * 2 + kind) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    step = (x >> np.uint64(32)) | np.uint64(1)
    return [((x + np.uint64(k) * step) % np.uint64(segment)).astype(np.int64) for k in range(PROBES)]


def _segments(segment: int):
    """(kind, bucket, hashes, counts) to (segment, data): the bits that a bucket sets in its segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, bucket, hashes, counts in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                h, levels = np.frombuffer(hashes, "<u8"), level_of(np.frombuffer(counts, "<i8"), kind)
                own = np.zeros(segment // 8, np.uint8)
                for level in range(1, int(levels.max(initial=0)) + 1):
                    for x in _positions(h[levels >= level], level, kind, segment):
                        np.bitwise_or.at(own, x >> 3, (1 << (x & 7)).astype(np.uint8))
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([own.tobytes()], pa.binary())], ["segment", "data"])

    return run


def _either(key: tuple, rows: pa.Table) -> pa.Table:
    both = np.bitwise_or.reduce([np.frombuffer(d.as_py(), np.uint8) for d in rows.column("data")])
    return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "data": pa.array([both.tobytes()], pa.binary())})


class LogFrequencyFilter:
    """Quantised n-gram counts by repeated membership probes, up to the largest level of each kind.

    data holds ``segments`` segments (a power of two) by the top bits of the hash, or a single one of them.
    """

    def __init__(self, data: np.ndarray, largest: dict[int, int], segments: int = 1):
        self.data, self.largest, self.segments = data, largest, segments
        self.segment = 8 * len(data) // segments

    def levels(self, hashes: np.ndarray, kind: int) -> np.ndarray:
        out, at = np.zeros(len(hashes), np.int64), np.arange(len(hashes))
        bits = self.segments.bit_length() - 1
        base = (hashes >> np.uint64(64 - bits)).astype(np.int64) * self.segment if bits else np.zeros(len(hashes), np.int64)
        for level in range(1, self.largest.get(kind, 0) + 1):
            for k in range(PROBES):
                if len(at):
                    at = at[self._set(base[at] + _positions(hashes[at], level, kind, self.segment)[k])]
            if not len(at):
                break
            out[at] = level
        return out

    def _set(self, x: np.ndarray) -> np.ndarray:
        return (self.data[x >> 3] >> (x & 7).astype(np.uint8)) & 1 == 1


class Answers:
    """The levels of a run's n-grams as the segments gave them, in the order of the run's different filter keys."""

    def __init__(self, found: dict[int, np.ndarray]):
        self.found = found

    def levels(self, hashes: np.ndarray, kind: int) -> np.ndarray:
        """The levels of all words or all bigrams of the run."""
        keys = hashes & KEY
        order = np.argsort(keys)
        out = np.empty(len(keys), np.int64)
        out[order] = self.found[kind][np.cumsum(_new(keys[order])) - 1]
        return out


def _six(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def _from_six(data: bytes, offset: int) -> np.ndarray:
    out = np.zeros(((len(data) - offset) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8, offset=offset).reshape(-1, 6)
    return out.view("<u8").ravel()


class Model:
    """What workers hold: the filter (None where its segments are asked), the totals, the dictionary of exact counts."""

    def __init__(self, filter_: LogFrequencyFilter | Answers | None, total: int, distinct: int, words: np.ndarray, counts: np.ndarray):
        self.filter, self.total, self.distinct = filter_, total, distinct
        self.words, self.counts = words, counts

    def token_scores(self, token: np.ndarray, pair: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per token: log10 of the add-one estimate from exact counts (0 where the dictionary has not the word), whether it has,
        and log10 P(token | token before): the bigram estimate, smoothed by the add-one word estimate."""
        names, where = np.unique(token, return_inverse=True)
        at = np.minimum(np.searchsorted(self.words, names), max(0, len(self.words) - 1))
        known = self.words[at] == names if len(self.words) else np.zeros(len(names), bool)
        base = np.zeros(len(names))
        base[known] = np.log10((self.counts[at[known]] + 1) / (self.total + self.distinct + 1))
        word = np.minimum(count_of(self.filter.levels(names, 1), 1), self.total)[where]
        before = np.concatenate([[0.0], word[:-1]])
        first = np.cumsum(counts) - counts
        before[first] = word[counts[:1] - 1]  # each text's last token is the end that its first one follows
        double = np.minimum(count_of(self.filter.levels(pair, 2), 2), before)
        single = (word + 1) / (self.total + self.distinct + 1)
        return base[where], known[where], np.log10((double + PRIOR * single) / (before + PRIOR))


def train(docs: DataFrame, *, text_column: str = "text", filter_bytes: int = FILTER_BYTES, dictionary_words: int = DICTIONARY_WORDS) -> tuple[Model, DataFrame, DataFrame, dict[int, int], int]:
    """The model, (hash, count) of every training word as a DataFrame over written buckets, and the filter's
    segments (segment, data), the largest level of each kind and the number of segments."""
    texts = docs.select(text_or_empty(text_column).alias("text"))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(64, 1 << math.ceil(math.log2(max(1, chars / BUCKET_CHARS))))
    counted = texts.mapInArrow(_count(buckets), "kind int, bucket long, data binary")
    schema = "kind int, bucket long, total long, distinct long, pairs long, most long, powers array<long>, hashes binary, counts binary"
    # As many tasks as buckets, so a task's share stays the same however large the input is.
    merged = written(counted.repartition(buckets, "kind", "bucket").groupBy("kind", "bucket").applyInArrow(_merge, schema), "ngrams", ARRAYS_PER_BATCH)
    own = merged.groupBy("kind").agg(F.sum("total").alias("total"), F.sum("distinct").alias("distinct"), F.sum("pairs").alias("pairs"), F.max("most").alias("most")).collect()
    words = next((r for r in own if r["kind"] == 1), None)
    pairs = sum(r["pairs"] for r in own)
    largest = {r["kind"]: int(level_of(np.array([r["most"]]), r["kind"])[0]) for r in own}
    # A bucket's n-grams are all in one segment.
    size = max(8 * buckets, 1 << max(12, math.ceil(math.log2(max(1, pairs * BITS_PER_PAIR / 8)))))
    parts = merged.select("kind", "bucket", "hashes", "counts").mapInArrow(_segments(8 * size // buckets), "segment long, data binary")
    built = parts.groupBy("segment").applyInArrow(_either, "segment long, data binary")
    filter_ = None
    if size <= filter_bytes:
        data, segment = np.zeros(size, np.uint8), size // buckets
        for r in built.toLocalIterator():
            data[r["segment"] * segment : (r["segment"] + 1) * segment] = np.frombuffer(bytes(r["data"]), np.uint8)
        filter_ = LogFrequencyFilter(data, largest, buckets)
    # Powers of two of a count, from the top, as long as the words that reach them fit in the dictionary.
    powers = [r["n"] for r in merged.filter("kind = 1").select(F.posexplode("powers").alias("power", "n")).groupBy("power").agg(F.sum("n").alias("n")).orderBy("power").collect()]
    least, fits = 63, 0
    while least > 0 and fits + (powers[least - 1] if powers else 0) <= dictionary_words:
        least -= 1
        fits += powers[least] if powers else 0
    top = merged.filter("kind = 1").select("hashes", "counts").mapInArrow(_unpacked(1 << least), "hash long, count long")
    known = top.toArrow()
    hashes, count = known["hash"].to_numpy().view(np.uint64), known["count"].to_numpy()
    order = np.argsort(hashes)
    model = Model(filter_, words["total"] if words else 0, words["distinct"] if words else 0, hashes[order], count[order])
    return model, merged.filter("kind = 1").select("hashes", "counts").mapInArrow(_unpacked(1), "hash long, count long"), built, largest, buckets


def _unpacked(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                count = np.frombuffer(counts, "<i8")
                kept = count >= least
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(hashes, "<i8")[kept]), pa.array(count[kept])], ["hash", "count"])

    return run


def _scored(m: Model, part: pa.RecordBatch) -> pa.RecordBatch:
    """The scores of (id, text) rows, and the words of each that the dictionary has not."""
    token, pair, counts = run_tokens(part.column(1))
    starts = np.cumsum(counts) - counts
    base, known, score = m.token_scores(token, pair, counts)
    text = np.repeat(np.arange(len(part), dtype=np.int64), counts)[~known]
    rare = np.flatnonzero(~known)
    order = np.lexsort((token[rare], text))
    text, rare = text[order], token[rare][order]
    new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (rare[1:] != rare[:-1])])) if len(rare) else np.zeros(0, np.int64)
    times = np.diff(np.append(new, len(rare)))
    ends = np.searchsorted(text[new], np.arange(len(part) + 1))
    lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int64())) for v in (rare[new].view(np.int64), times)]
    sums = [np.add.reduceat(v, starts) for v in (base, known.astype(np.int64), score)]
    return pa.RecordBatch.from_arrays([part.column(0), pa.array(counts.astype(np.int64)), *map(pa.array, (sums[1], sums[0], sums[2])), *lists], ["id", "n_tokens", "n_known", "base_score", "score", "rare", "times"])


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in runs(batch.column(1)):
                yield _scored(model.value, batch.slice(a, b - a))

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (run, segment, data): runs of rows, as segment -1."""

    def flush(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for part in parts:
                out.write_batch(part)
        run = (TaskContext.get().partitionId() << 32) + number
        return pa.RecordBatch.from_arrays([pa.array([run], pa.int64()), pa.array([-1], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["run", "segment", "data"])

    parts, size, number = [], 0, 0
    for batch in batches:
        for a, b in runs(batch.column(1)):
            parts.append(batch.slice(a, b - a))
            size += parts[-1].column(1).nbytes
            if size >= RUN_OF_TEXTS:
                yield flush(number, parts)
                parts, size, number = [], 0, number + 1
    if parts:
        yield flush(number, parts)


def _texts(stream) -> pa.RecordBatch:
    """The (id, text) rows of a run as one batch."""
    rows = pa.ipc.open_stream(stream).read_all()
    return pa.RecordBatch.from_arrays([pa.concat_arrays(c.chunks) for c in rows.cast(pa.schema([rows.schema.field(0), ("text", pa.large_string())])).columns], ["id", "text"])


def _ask(segments: int):
    """(run, segment, data) of runs to the same of each run's distinct n-grams in each segment."""
    inner = (np.arange(1, segments, dtype=object) * (1 << 64) // segments).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, texts in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                token, pair, _ = run_tokens(_texts(texts.as_buffer()).column(1))
                names = [_distinct(x & KEY) for x in (token, pair)]
                cut = [[0, *np.searchsorted(x, inner).tolist(), len(x)] for x in names]
                rows = []
                for k in range(segments):
                    first, second = (x[c[k] : c[k + 1]] for x, c in zip(names, cut, strict=True))
                    if len(first) or len(second):
                        rows.append((k, np.array([len(first)], "<i8").tobytes() + _six(first) + _six(second)))
                segment, data = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(rows), pa.int64()), pa.array(segment, pa.int64()), pa.array(data, pa.binary())], ["run", "segment", "data"])

    return run


def _answer(largest: dict[int, int]):
    """(run, segment, data) by segment, the filter's first as run -1, to the same with the n-grams' levels behind them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, filter_ = -1, None
        for batch in batches:
            rows = []
            for number, segment, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if number < 0:
                    held, filter_ = segment, LogFrequencyFilter(np.frombuffer(data, np.uint8), largest)
                    continue
                names = _from_six(data, 8)
                first = int(np.frombuffer(data, "<i8", 1)[0])
                if segment == held:
                    levels = np.concatenate([filter_.levels(names[:first], 1), filter_.levels(names[first:], 2)])
                else:  # no training n-gram is there
                    levels = np.zeros(len(names), np.int64)
                rows.append((number, segment, np.array([first], "<i8").tobytes() + levels.astype(np.uint8).tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["run", "segment", "data"])

    return run


def _score_answered(model):
    """(run, segment, data) by run and segment, its texts first and then the answers, to the scores."""

    def scores(texts: bytes, answers: list[bytes]) -> pa.RecordBatch:
        split = [(np.frombuffer(x, np.uint8, offset=8), int(np.frombuffer(x, "<i8", 1)[0])) for x in answers]
        found = {1: np.concatenate([x[:n] for x, n in split]), 2: np.concatenate([x[n:] for x, n in split])}
        shared: Model = model.value
        return _scored(Model(Answers(found), shared.total, shared.distinct, shared.words, shared.counts), _texts(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, answers = None, []
        for batch in batches:
            for segment, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if segment >= 0:
                    answers.append(data)
                    continue
                if texts is not None:
                    yield scores(texts, answers)
                texts, answers = data, []
        if texts is not None:
            yield scores(texts, answers)

    return run


def _by_segments(slim: DataFrame, shared, built: DataFrame, largest: dict[int, int], segments: int, schema: str) -> DataFrame:
    """The scored rows of (id, text) by a filter that no worker holds as a whole."""
    layout = "run long, segment long, data binary"
    texts = written(slim.mapInArrow(_runs, layout), "runs", TEXTS_PER_BATCH)
    filters = built.select(F.lit(-1).cast("long").alias("run"), "segment", "data")
    met = filters.union(texts.mapInArrow(_ask(segments), layout)).repartition(segments, "segment").sortWithinPartitions("segment", "run")
    answered = written(met.mapInArrow(_answer(largest), layout), "answers", ASKED_PER_BATCH)
    # Each task scores about one run; the runs are counted, so there are as many tasks.
    back = texts.union(answered).repartition(max(1, texts.count()), "run").sortWithinPartitions("run", "segment")
    return back.mapInArrow(_score_answered(shared), schema)


def score_documents(docs: DataFrame, training: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", filter_bytes: int = FILTER_BYTES, dictionary_words: int = DICTIONARY_WORDS) -> DataFrame:
    """One row per document: the id, n_tokens, n_known, train_tokens, base_score, score.

    score is the model's log10 probability of the whole text, base_score that of exact add-one word
    counts. A null text is empty and scores its end token; repeated rows are scored alike; with no
    training rows every probability is 1; other columns are not read; no rows give no rows.
    """
    spark: SparkSession = docs.sparkSession
    model, counts, built, largest, segments = train(training, text_column=text_column, filter_bytes=filter_bytes, dictionary_words=dictionary_words)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_column].dataType.simpleString()
    slim = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    schema = f"id {kind}, n_tokens long, n_known long, base_score double, score double, rare array<long>, times array<long>"
    whole = model.filter is not None
    scored = slim.mapInArrow(_score(shared), schema) if whole else _by_segments(slim, shared, built, largest, segments, schema)
    scored = written(scored.withColumn("rid", F.monotonically_increasing_id()), "scored", TEXTS_PER_BATCH if whole else ASKED_PER_BATCH)
    rare = scored.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("rid", F.col("r.rare").alias("hash"), F.col("r.times").alias("times"))
    denominator = float(model.total + model.distinct + 1)
    found = rare.join(counts, "hash", "left").groupBy("rid").agg(
        F.sum(F.when(F.col("count").isNotNull(), F.col("times")).otherwise(0)).alias("more"),
        F.sum(F.col("times") * F.log10((F.coalesce("count", F.lit(0)) + 1) / F.lit(denominator))).alias("rest"),
    )
    out = scored.drop("rare", "times").join(found, "rid", "left")
    return out.select(F.col("id").alias(id_column), "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), "score")
