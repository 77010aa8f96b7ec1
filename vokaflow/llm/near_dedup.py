"""MinHash near-dedup of weighted word shingles: BagMinHash signatures, bands, exact overlap.

A text is the multiset of its five-word shingles. BagMinHash gives every (shingle, unit of
weight) a Poisson process over time and takes, for each register, the first point over all units
that the multiset has; two multisets agree in a register with a probability equal to their
weighted Jaccard similarity. Weights are discretised to whole counts and the units are halved
hierarchically: [0,1), [1,2), [2,4), [4,8), ... each has one process of proportional rate, whose
points are thinned by their level where the count covers an interval in part. A text only ever
generates points up to a time by which its registers are almost surely full, and goes on where one is not.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import HEAVY, TEXTS_PER_BATCH, dropped, spread_join, text_or_empty, written
from .hashing import mix, runs, unit, word_hashes

SHINGLE, SIMILARITY = 5, 0.8
#: A pair of similarity s shares a band with probability 1 - (1 - s**ROWS)**BANDS: 0.99994 at 0.8.
BANDS, ROWS = 32, 6
REGISTERS = BANDS * ROWS
#: A bucket whose texts outside its largest component make more comparisons than this with all its texts compares
#: whole texts, in blocks of about BLOCK_WORDS words that meet in a task each and leave only links; below, pairs with alike sketches meet.
MOST_PAIRED, BLOCK_WORDS = 1 << 10, 400_000
#: PLANES bits a register make a sketch. Registers differ in it with probability (1 - similarity) * (1 - 2**-PLANES), so
#: at 0.8 more than MOST_APART of 192 do for one pair in some 100,000s. Totals limit a similarity too.
PLANES, SKETCH_LONGS, MOST_APART = 4, REGISTERS // 64, 60
#: A list of so many wanted texts (40 bytes each) may be broadcast; a longer one is joined by shuffle.
BROADCAST_TEXTS = 200_000
_HASH_BITS = np.uint64(48)


def shingle_bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash of 48 bits, count), sorted. A text of one to four words is one shingle."""
    hashes, counts = word_hashes(texts)
    if len(texts) > 65_535:
        raise ValueError("at most 65,535 texts at once")
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
    rank = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    own = np.repeat(counts, counts)
    total = hashes.copy()
    for k in range(1, SHINGLE):
        following = np.zeros_like(hashes)
        following[:-k] = hashes[k:] if k < len(hashes) else 0
        total = mix(total) + np.where(rank + k < own, following, np.uint64(k))
    there = (rank + SHINGLE <= own) | ((rank == 0) & (own < SHINGLE))
    keys = np.sort((text[there] << _HASH_BITS) | (mix(total[there]) >> (np.uint64(64) - _HASH_BITS)))
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    kept = keys[new]
    return (kept >> _HASH_BITS).astype(np.int64), kept & np.uint64((1 << 48) - 1), np.diff(np.append(new, len(keys)))


def signatures(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, n_texts: int, registers: int = REGISTERS) -> np.ndarray:
    """BagMinHash signatures, one row per text; texts without shingles have zeros."""
    out = np.zeros((n_texts, registers), dtype=np.uint64)
    weight = np.bincount(text, weights=count, minlength=n_texts)
    limit = registers * (np.log(registers) + 5.0) / np.maximum(weight, 1.0)
    todo = weight > 0
    while todo.any():
        own = todo[text]
        best, value = _points(text[own], shingle[own], count[own], limit, n_texts, registers)
        full = todo & np.isfinite(best).all(axis=1)
        out[full] = value[full]
        todo &= ~full
        limit = limit * 2
    return out


def _points(text, shingle, count, limit, n_texts, registers):
    best = np.full(n_texts * registers, np.inf)
    value = np.zeros(n_texts * registers, dtype=np.uint64)
    found: list[tuple] = []
    low, width, j = 0, 1, 0
    at = np.arange(len(text))
    while len(at := at[count[at] > low]):  # the process of units [low, low + width)
        seed = mix(shingle[at] + np.uint64((j + 1) * 0xA24BAED4963EE407 & (1 << 64) - 1))
        elem, time, k = at, np.zeros(len(at)), 1
        most = limit[text[at]]
        while len(elem):
            x = mix(seed + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            time = time - np.log(unit(x)) / width
            alive = time < most
            elem, seed, time, most, x = elem[alive], seed[alive], time[alive], most[alive], x[alive]
            if len(elem):
                y = mix(x ^ np.uint64(0x5851F42D4C957F2D))
                take = slice(None)
                if width > 1:
                    take = low + (y >> np.uint64(32)) % np.uint64(width) < count[elem].astype(np.uint64)
                register = ((y & np.uint64(0xFFFFFFFF)) % np.uint64(registers)).astype(np.int64)
                found.append(((text[elem] * registers + register)[take], time[take], y[take]))
            k += 1
        low, width, j = low + width, max(1, low + width), j + 1
    if found:
        key, time, y = (np.concatenate(c) for c in zip(*found, strict=True))
        np.minimum.at(best, key, time)
        won = time == best[key]
        value[key[won]] = y[won]
    return best.reshape(n_texts, registers), value.reshape(n_texts, registers)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(texts, BANDS) keys; the band number is part of a key."""
    key = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(signature), BANDS)).copy()
    for row in range(ROWS):
        key = mix(key ^ signature[:, row::ROWS][:, :BANDS])
    return key


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in runs(batch.column(2), 1000):
            part = batch.slice(a, b - a)
            bags = shingle_bags(part.column(2))
            signature = signatures(*bags, len(part))
            weight = np.bincount(bags[0], weights=bags[2], minlength=len(part)).astype(np.int64)
            bands = [k.tobytes() if w else None for k, w in zip(band_keys(signature), weight, strict=True)]
            planes = [np.packbits(((signature >> np.uint64(k)) & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64) for k in range(PLANES)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(bands, pa.binary()), pa.array(weight), *(pa.array(c) for p in planes for c in p.T)], ["id", "th", "bands", *_NUMBERS])


_NUMBERS = ("weight", *(f"s{p}{k}" for p in range(PLANES) for k in range(SKETCH_LONGS)))


def _apart(left: str, right: str) -> Column:
    """In how many registers two sketched rows differ."""
    differ = [reduce(Column.bitwiseOR, (F.col(f"{left}.s{p}{k}").bitwiseXOR(F.col(f"{right}.s{p}{k}")) for p in range(PLANES))) for k in range(SKETCH_LONGS)]
    return reduce(Column.__add__, map(F.bit_count, differ))


def _alike(left: str, right: str) -> Column:
    """Whether two sketched rows may reach the threshold."""
    lw, rw = F.col(f"{left}.weight"), F.col(f"{right}.weight")
    return (F.least(lw, rw) >= F.greatest(lw, rw) * SIMILARITY) & (_apart(left, right) <= MOST_APART)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common / max(1, int(a[1].sum()) + int(b[1].sum()) - common)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text a, text b) to the (a, b) that are similar; rows of one a mostly come together."""
    bag_of = lambda text: shingle_bags(pa.array([text]))[1:]
    last, bag = None, None
    for batch in batches:
        left, right, linked = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
        for i, a in enumerate(left):
            if a != last:
                last, bag = a, bag_of(batch.column(2)[i].as_py())
            linked.append(weighted_jaccard(bag, bag_of(batch.column(3)[i].as_py())) >= SIMILARITY)
        yield pa.RecordBatch.from_arrays([pa.array([x for x, k in zip(c, linked, strict=True) if k], pa.int64()) for c in (left, right)], ["a", "b"])


def _compare(key: tuple, rows: pa.Table) -> pa.Table:
    """The links (a, b) between the texts that ask, all outside the bucket's largest component, and other components' texts.

    One text's bag is looked up in the bags of all at once, so no pair is ever made but a link.
    """
    node, comp, top = (rows.column(c).to_numpy() for c in ("node", "comp", "top"))
    asks = rows.column("asks").to_numpy(zero_copy_only=False)
    text, count, shingle = [], [], []
    texts = pa.concat_arrays([pa.array([], pa.large_string()), *rows.column("text").cast(pa.large_string()).chunks])
    for a, b in runs(texts, 1000):
        t, h, c = shingle_bags(texts.slice(a, b - a))
        text.append(t + a), shingle.append(h), count.append(c)
    text, shingle, count = (np.concatenate(x) for x in (text, shingle, count))
    weight = np.bincount(text, weights=count, minlength=len(node))
    ends = np.searchsorted(text, np.arange(len(node) + 1))
    out: list[np.ndarray] = []
    for i in np.flatnonzero(asks):
        h, c = shingle[ends[i] : ends[i + 1]], count[ends[i] : ends[i + 1]]
        at = np.minimum(np.searchsorted(h, shingle), len(h) - 1)
        hit = np.flatnonzero(h[at] == shingle)
        common = np.bincount(text[hit], weights=np.minimum(c[at[hit]], count[hit]), minlength=len(node))
        near = (common >= SIMILARITY * (weight + weight[i] - common)) & (comp != comp[i]) & ((comp == top) | (node > node[i]))
        out.append(np.stack([np.minimum(node[near], node[i]), np.maximum(node[near], node[i])]))
    a, b = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def connected(edges: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of edges (a, b): comp is the least node that a path reaches.

    Each round every node of the contracted graph takes the least label next to it, labels are
    shortened by two jumps, and edges inside a component go; labels that are not final yet leave
    an edge to what they point at. Nothing is gathered on the driver.
    """

    def both(df: DataFrame) -> DataFrame:
        return written(df.union(df.select("b", "a")).filter("a <> b").distinct(), "edges")

    rest = both(edges.select("a", "b"))
    comps: DataFrame | None = None
    while not rest.isEmpty():
        near = rest.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("up"))
        once = near.join(near.select(F.col("node").alias("up"), F.col("up").alias("up2")), "up").select("node", F.col("up2").alias("up"))
        parent = written(once.join(near.select(F.col("node").alias("up"), F.col("up").alias("beyond")), "up"), "parent")
        label = parent.select("node", "up")
        if comps is None:
            comps = label.withColumnRenamed("up", "comp")
        else:
            comps = written(comps.join(label.withColumnRenamed("node", "comp"), "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")), "comps")
        a, b = label.toDF("a", "ua"), label.toDF("b", "ub")
        open_ = parent.filter("up <> beyond").select(F.col("up").alias("a"), F.col("beyond").alias("b"))
        rest = both(rest.filter("a < b").join(a, "a").join(b, "b").select(F.col("ua").alias("a"), F.col("ub").alias("b")).union(open_))
    return comps if comps is not None else rest.select(F.col("a").alias("node"), F.col("b").alias("comp"))


class _Texts:
    """The texts of nodes, and the test of candidate pairs against them."""

    def __init__(self, docs: DataFrame, nodes: DataFrame):
        self.docs, self.nodes = docs, nodes
        self.sketch = nodes.select("node", *_NUMBERS)

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The distinct (a, b) pairs, a written table, whose sketches allow the threshold, as a written table."""
        left = _with_heads(pairs, self.sketch.select(F.col("node").alias("a"), F.struct(*_NUMBERS).alias("x")))
        return written(left.join(self.sketch.alias("y"), (F.col("b") == F.col("y.node")) & _alike("x", "y")).select(*pairs.columns), "likely")

    def of(self, named: DataFrame) -> DataFrame:
        """(node, text) of rows of (node)."""
        wanted = written(named.distinct().join(self.nodes, "node").select("node", F.col("rep").alias("_rep"), F.col("th").alias("_th")), "wanted")
        listed = F.broadcast(wanted) if wanted.count() <= BROADCAST_TEXTS else wanted
        texts = self.docs.join(listed, (F.col("th") == F.col("_th")) & F.col("id").eqNullSafe(F.col("_rep"))).select("node", "text")
        return written(texts, "texts").dropDuplicates(["node"])

    def compared(self, members: DataFrame) -> DataFrame:
        """The links within the buckets of members (key, node, comp, top, asks), as a written table."""
        rows = members.join(self.of(members.select("node")), "node").select("key", "node", "comp", "top", "asks", "text")
        return written(rows.groupBy("key").applyInArrow(_compare, "a long, b long").distinct(), "links")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Those of the distinct (a, b) pairs, a written table, whose overlap reaches the threshold, as a written table.

        A text that heads more than a HEAVY-th of the pairs is handed out in as many parts as its pairs need.
        """
        texts = self.of(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))))
        total = pairs.count()
        heavy = F.broadcast(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * HEAVY > total).select("a", F.ceil(F.col("n") * HEAVY / total).cast("long").alias("parts")))
        parts = F.coalesce("parts", F.lit(1).cast("long"))
        right = pairs.join(heavy, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), parts).alias("part")).join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        left = texts.withColumnsRenamed({"node": "a", "text": "text_a"}).join(heavy, "a", "left").select("a", "text_a", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
        rows = right.join(left, ["a", "part"])
        return written(rows.select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long"), "links", TEXTS_PER_BATCH)


def _with_heads(pairs: DataFrame, of: DataFrame) -> DataFrame:
    """Pairs (a, b) with the columns that ``of`` has for a, nulls where it has none; a may head any share of the pairs."""
    heads = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).join(of, "a", "left").withColumn("wanted", F.lit(True))
    return spread_join(pairs, heads, "a", pairs.count())


def _blocks(members: DataFrame) -> DataFrame:
    """Buckets cut for compared(): each block of the texts outside the largest component with each block of all texts."""
    blocks = lambda words: F.greatest(F.ceil(F.col(words) / BLOCK_WORDS).cast("long"), F.lit(1).cast("long"))
    every = lambda words: F.explode(F.sequence(F.lit(0).cast("long"), blocks(words) - 1))
    own = lambda words: F.pmod(F.xxhash64("node"), blocks(words))
    asking = members.filter("comp <> top").select("*", own("words_outside").alias("i"), F.lit(True).alias("asks")).select("*", every("words").alias("j"))
    asked = members.select("*", own("words").alias("j"), F.lit(False).alias("asks")).select("*", every("words_outside").alias("i"))
    return asking.unionByName(asked).select(F.xxhash64("key", "i", "j").alias("key"), "node", "comp", "top", "asks")


def _across(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Those of the pairs, a written table, that no chain of links joins yet."""
    of = lambda side: comps.select(F.col("node").alias(side), F.col("comp").alias(f"c{side}"))
    both = _with_heads(pairs, of("a")).join(of("b"), "b", "left")
    return both.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select(*pairs.columns)


def near_duplicate_classes(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: the id column, text_hash, class_id, kept.

    class_id is the least id of the class; kept marks that document. Classes are the connected
    components of "equal text, or weighted Jaccard similarity of 0.8 or more". Null texts are
    empty ones; texts without a word are copies of one another only if equal; repeated rows share a
    class (and are kept alike); other columns are not read; no rows give no rows.

    Candidates: each text of a band bucket is paired with the bucket's least text. A bucket that
    still holds several components afterwards pairs texts with alike sketches if small, and compares
    whole texts exactly, block by block over several tasks, if larger: no pair of a bucket is left out
    but by the sketch. Texts of any length are read whole; other columns may have any names.
    """
    text = text_or_empty(text_column)
    slim = docs.select(F.col(id_column).alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("th"), text.alias("text"))
    layout = T.StructType([*slim.schema.fields[:2], T.StructField("bands", T.BinaryType()), *(T.StructField(n, T.LongType()) for n in _NUMBERS)])
    sketched = written(slim.mapInArrow(_sketch, layout), "sketches", TEXTS_PER_BATCH)
    nodes = sketched.groupBy("th").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), *(F.first(n).alias(n) for n in ("bands", *_NUMBERS)))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(F.substring("bands", i * 8 + 1, F.lit(8))))
    keys = written(nodes.filter("bands is not null").select("node", F.posexplode(band).alias("band", "key")).drop("band"), "keys")
    total = keys.count()
    buckets = keys.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z"), F.count(F.lit(1)).alias("n"))
    buckets = written(buckets.withColumn("wanted", F.col("a") != F.col("z")).drop("z").filter(F.col("wanted") | (F.col("n") * HEAVY > total)), "buckets")
    members = written(spread_join(keys, buckets, "key", total), "members")
    dropped(keys, buckets)
    stars = written(members.filter("a <> node").groupBy("a", F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("shared")), "stars")

    texts = _Texts(slim, nodes)
    likely = texts.likely(stars)
    dropped(stars)
    nearest = written(likely.groupBy("b").agg(F.max(F.struct("shared", (-F.col("a")).alias("a"))).alias("m")).select((-F.col("m.a")).alias("a"), "b"), "nearest")
    edges = texts.linked(nearest)
    comps = connected(edges)
    # The other heads come next: they join nearly all of a dense group before its rest is compared.
    rest = written(likely.select("a", "b").join(nearest, ["a", "b"], "left_anti"), "rest")
    others = written(_across(rest, comps), "others")
    if not others.isEmpty():
        edges = edges.union(texts.linked(others))
        comps = connected(edges)

    placed = members.select("key", "node").join(nodes.select("node", "weight"), "node").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    placed = written(placed, "placed")
    own = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"), F.sum("weight").alias("w"))
    several = own.groupBy("key").agg(F.sum("m").alias("n"), F.sum("w").alias("words"), F.max(F.struct("m", "comp", "w")).alias("largest"))
    outside = F.col("n") - F.col("largest.m")
    several = several.select("key", "n", F.col("largest.comp").alias("top"), "words", (F.col("words") - F.col("largest.w")).alias("words_outside"), (outside * F.col("n")).alias("compared"), (outside > 0).alias("wanted"))
    # The buckets that hold several components, with their component, the largest one and its cost.
    open_ = written(spread_join(placed.drop("weight"), several, "key", placed.count()), "open")
    small, large = open_.filter(F.col("compared") <= MOST_PAIRED).join(texts.sketch, "node"), open_.filter(F.col("compared") > MOST_PAIRED)
    x, y = small.filter("comp <> top").alias("x"), small.alias("y")
    across = (F.col("x.comp") != F.col("y.comp")) & ((F.col("y.comp") == F.col("y.top")) | (F.col("x.node") < F.col("y.node")))
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & across & _alike("x", "y"))
    pairs = pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    pairs = written(pairs.join(likely.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    found = [f(rows) for f, rows in ((texts.linked, pairs), (lambda rows: texts.compared(_blocks(rows)), large)) if not rows.isEmpty()]
    for links in found:
        edges = edges.union(links)
    if any(not links.isEmpty() for links in found):
        comps = connected(edges)

    of = nodes.select("node", "th", "rep", "copies").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = of.groupBy("comp").agg(F.min(F.struct("rep", "th")).alias("m"))
    named = of.join(least, "comp").select("th", F.col("m.rep").alias("class_id"), (F.col("th") == F.col("m.th")).alias("first"), F.col("copies").alias("n"), F.lit(True).alias("wanted"))
    out = spread_join(sketched.select("id", "th"), written(named, "classes"), "th", sketched.count())
    dropped(members, likely, nearest, rest, others, placed, open_, pairs)
    return out.select(F.col("id").alias(id_column), F.lower(F.hex("th")).alias("text_hash"), "class_id", (F.col("id").eqNullSafe(F.col("class_id")) & F.col("first")).alias("kept"))
