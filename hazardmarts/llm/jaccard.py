"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets decide.

Documents link when the Jaccard similarity of their sets of word n-grams reaches the threshold. Rows and
bands are chosen for a target recall at that threshold. The steps:

1. Every row gets the identity of its n-gram set (a 128-bit hash) and its band hashes. Rows with
   equal sets are one *set* from here on, with the number of its copies; copies are never paired.
2. Sets are dealt by band hash. Bands with one set are dropped after a count with map-side aggregation.
   A bucket of many sets, or of large ones, is cut into tiles of at most about ``TILE`` x ``TILE`` sets and
   ``TILE_GRAMS`` n-grams, spread over tasks.
3. Within a tile, the pairs that agree in this band and in none before it are this tile's. Only sets
   with such a pair travel on, with their full n-gram sets, to be compared exactly.
4. A tile returns one row per set: the sum of copies it links to, and one edge to the root of its part of
   the tile. Pairs are counted in numpy blocks and never become rows.
5. Edges are contracted to components by alternating star steps, each written to the shared folder.

Words are runs between ASCII white space, lower-cased. A text of fewer words than n has one n-gram, all of
its words. Null texts count as empty; empty texts have no n-gram and link to nothing, not even to each other.
Rows with null ids take part, and a class of null ids only has a null class id. Repeated rows are copies of
each other. Texts of any length are read whole. Only the id and text columns are read, so further columns cannot
clash. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardmarts.llm.arrays import LOWER, SPACE, WordHashes, mix64, rolling, runs
from hazardmarts.llm.common import stored, text_of

TILE = 256
TILE_GRAMS = 4 << 20
MAX_HASHES = 64


@dataclass(frozen=True)
class Banding:
    bands: int
    rows: int

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    def recall(self, similarity: float) -> float:
        return 1 - (1 - similarity**self.rows) ** self.bands


def choose_banding(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> Banding:
    """The most rows per band, thus the fewest false candidates, that reach the recall at the threshold
    with at most ``max_hashes`` hashes."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= max_hashes:
            best = Banding(bands, rows)
    if best is None:
        raise ValueError("no banding of so few hashes reaches this recall")
    return best


def shingles(hashes: WordHashes, texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of the n-grams of each text."""
    return (np.unique(rolling(words, n)) for words in hashes.each(texts))


class Signer:
    """Band hashes of an n-gram set."""

    def __init__(self, banding: Banding) -> None:
        draw = np.random.default_rng(20)
        self.shape = banding
        self.factor = draw.integers(0, 2**32, banding.hashes, dtype=np.uint32)[:, None] | np.uint32(1)
        self.shift = draw.integers(0, 2**32, banding.hashes, dtype=np.uint32)[:, None]

    def bands(self, grams: np.ndarray) -> np.ndarray:
        low = (grams ^ (grams >> np.uint64(32))).astype(np.uint32)
        least = np.full(self.shape.hashes, 2**32 - 1, dtype=np.uint32)
        for at in range(0, len(low), 2048):
            least = np.minimum(least, (self.factor * low[None, at : at + 2048] + self.shift).min(axis=1))
        values = least.reshape(self.shape.bands, self.shape.rows).astype(np.uint64)
        out = np.arange(1, self.shape.bands + 1, dtype=np.uint64)
        for r in range(self.shape.rows):
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + values[:, r])
        return out.view(np.int64)


SIGNED = pa.schema([
    ("doc_id", pa.int64()), ("text_id", pa.string()), ("set_id", pa.binary()), ("size", pa.int64()),
    ("bands", pa.list_(pa.int64())),
])
SIGNED_DDL = "doc_id bigint, text_id string, set_id binary, size bigint, bands array<bigint>"


def signed(docs: DataFrame, n: int, banding: Banding) -> DataFrame:
    """Set identity and band hashes of every row of (doc_id, text_id, text)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, signer = WordHashes(LOWER, SPACE), Signer(banding)
        with np.errstate(over="ignore"):
            for batch in batches:
                ids, sizes, bands = [], [], []
                for grams in shingles(hashes, batch.column("text"), n):
                    sizes.append(len(grams))
                    ids.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
                    bands.append(signer.bands(grams) if len(grams) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text_id"), pa.array(ids, pa.binary()),
                     pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], schema=SIGNED,
                )

    return docs.select("doc_id", "text_id", F.col("text").cast("binary").alias("text")).mapInArrow(sign, SIGNED_DDL)


def gram_sets(texts: DataFrame, n: int) -> DataFrame:
    """set_id and the n-gram hashes as bytes, of rows (set_id, text)."""
    schema = pa.schema([("set_id", pa.binary()), ("grams", pa.binary())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(LOWER, SPACE)
        with np.errstate(over="ignore"):
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    grams = [g.tobytes() for g in shingles(hashes, part.column("text"), n)]
                    yield pa.RecordBatch.from_arrays([part.column("set_id"), pa.array(grams, pa.binary())], schema=schema)

    return texts.select("set_id", F.col("text").cast("binary").alias("text")).mapInArrow(build, "set_id binary, grams binary")


def tiles(sets: DataFrame, tile: int) -> DataFrame:
    """(key, ta, tb, chunk, band, set_id) for every bucket of two or more sets, cut into tiles."""
    dealt = sets.select("set_id", "size", F.posexplode("bands").alias("band", "key"))
    shared = dealt.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("n"), F.sum("size").alias("grams")).where("n > 1")
    cut = F.least("n", F.greatest(F.ceil(F.col("n") / tile), F.ceil(F.col("grams") / TILE_GRAMS))).cast("int")
    placed = dealt.join(shared, F.col("key") == F.col("k")).select(
        "set_id", "band", "key", cut.alias("cuts"), F.pmod(F.xxhash64("set_id"), cut).cast("int").alias("chunk")
    )
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    return other.select(
        "key", F.least("chunk", "other").alias("ta"), F.greatest("chunk", "other").alias("tb"), "chunk", "band", "set_id"
    )


def _own_pairs(bands: np.ndarray, band: int, chunk: np.ndarray, ta: int, tb: int) -> np.ndarray:
    """Which pairs i < j of a tile agree in this band and in none before; a boolean matrix."""
    n = len(bands)
    own = np.triu(np.ones((n, n), dtype=bool), 1)
    if ta != tb:
        own &= chunk[:, None] != chunk[None, :]
    own &= bands[:, None, band] == bands[None, :, band]
    for b in range(band):
        own &= bands[:, None, b] != bands[None, :, b]
    return own


KEYS = ["key", "ta", "tb"]


def _matrix(table: pa.Table, name: str, width: int) -> np.ndarray:
    return np.concatenate([c.values.to_numpy()[c.offsets[0].as_py() : c.offsets[-1].as_py()] for c in table.column(name).chunks]).reshape(-1, width)


def _members(width: int):
    """Rows of a tile that take part in a pair of this tile."""
    schema = pa.schema([
        ("key", pa.int64()), ("ta", pa.int32()), ("tb", pa.int32()), ("chunk", pa.int32()), ("band", pa.int32()),
        ("set_id", pa.binary()),
    ])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for t in runs(batches, KEYS):
            if t.num_rows < 2:
                continue
            own = _own_pairs(
                _matrix(t, "bands", width), t.column("band")[0].as_py(), t.column("chunk").to_numpy(),
                t.column("ta")[0].as_py(), t.column("tb")[0].as_py(),
            )
            mine = own.any(axis=0) | own.any(axis=1)
            if mine.any():
                held.append(t.select(schema.names).filter(pa.array(mine)).cast(schema))
                if len(held) >= 1000:
                    yield from pa.concat_tables(held).combine_chunks().to_batches()
                    held = []
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    return keep


def similar(grams: list[np.ndarray], own: np.ndarray, threshold: float) -> np.ndarray:
    """The pairs of ``own`` whose exact Jaccard similarity reaches the threshold."""
    sizes = np.array([len(g) for g in grams], dtype=np.int64)
    rows, columns = np.nonzero(own)
    out = np.zeros_like(own)
    if len(rows) <= 16:
        for i, j in zip(rows, columns, strict=True):
            both = np.intersect1d(grams[i], grams[j], assume_unique=True).size
            out[i, j] = both >= threshold * (sizes[i] + sizes[j] - both) - 1e-9
        return out
    # Many pairs: counts of common n-grams as products of incidence blocks, of the n-grams that two sets share.
    value, where, count = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(grams)), sizes)
    column = np.cumsum(count > 1) - 1
    use = count[where] > 1
    column, owner = column[where[use]], owner[use]
    width = int((count > 1).sum())
    both = np.zeros(own.shape, dtype=np.float64)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for at in range(0, width, 8192):
        low, high = np.searchsorted(column, [at, at + 8192])
        block = np.zeros((len(grams), min(8192, width - at)), dtype=np.float32)
        block[owner[low:high], column[low:high] - at] = 1
        both += block @ block.T
    union = sizes[:, None] + sizes[None, :] - both
    return own & (both >= threshold * union - 1e-9)


def _roots(linked: np.ndarray) -> np.ndarray:
    """The smallest member of each member's part under the links."""
    n = len(linked)
    label = np.arange(n)
    while True:
        low = np.where(linked, label[None, :], n).min(axis=1, initial=n)
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _verified(width: int, threshold: float):
    schema = pa.schema([("set_id", pa.binary()), ("other", pa.binary()), ("links", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, others, counts = [], [], []
        for t in runs(batches, KEYS):
            own = _own_pairs(
                _matrix(t, "bands", width), t.column("band")[0].as_py(), t.column("chunk").to_numpy(),
                t.column("ta")[0].as_py(), t.column("tb")[0].as_py(),
            )
            grams = [np.frombuffer(g, dtype=np.uint64) for g in t.column("grams").to_pylist()]
            linked = similar(grams, own, threshold)
            linked |= linked.T
            if not linked.any():
                continue
            links = linked @ t.column("copies").to_numpy()
            root = _roots(linked)
            names = t.column("set_id").to_pylist()
            for i in np.flatnonzero(links):
                ids.append(names[i])
                others.append(names[root[i]])
                counts.append(int(links[i]))
            if len(ids) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(others, pa.binary()), pa.array(counts)], schema=schema)
                ids, others, counts = [], [], []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(others, pa.binary()), pa.array(counts)], schema=schema)

    return verify


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the smallest node of its component.

    Alternating large-star and small-star steps; each is an aggregation and a join on the node, and
    its result is written to the shared folder.
    """

    def tag(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    def large(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("n")).agg(F.min(F.least("u", "v")).alias("m"))
        return both.where("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v")
        least = down.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        step = down.join(least, F.col("u") == F.col("n"))
        hung = step.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return hung.unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct()

    e = stored(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = tag(e)
    while True:
        e = stored(small(large(e)), "edges")
        now = tag(e)
        if now == mark:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def link_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8,
    recall: float = 0.999, tile: int = TILE,
) -> DataFrame:
    """One row per input row: doc_id, text_id (hash of the text), ``class_id`` (the smallest id of its class),
    ``n_links`` (how many other rows it links to) and ``copies`` (rows with an equal n-gram set, itself included)."""
    banding = choose_banding(threshold, recall)
    body = text_of(text)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.md5(body.cast("binary")).alias("text_id"), body.alias("text"))
    marks = stored(signed(rows, n, banding), "signatures")
    sets = stored(
        marks.where("size > 0").groupBy("set_id").agg(
            F.min(F.struct("text_id", "doc_id")).alias("rep"), F.min("doc_id").alias("least_id"),
            F.count("*").alias("copies"), F.first("size").alias("size"), F.first("bands").alias("bands"),
        ),
        "sets",
    )
    bands = sets.select(F.col("set_id").alias("s"), "bands", "copies", "rep")
    placed = tiles(sets, tile).join(bands.drop("copies", "rep"), F.col("set_id") == F.col("s")).drop("s")
    width = banding.bands
    needed = stored(
        placed.repartition(*KEYS).sortWithinPartitions(*KEYS)
        .mapInArrow(_members(width), "key bigint, ta int, tb int, chunk int, band int, set_id binary"),
        "candidates",
    )
    chosen = needed.select("set_id").distinct().join(bands.drop("bands", "copies"), F.col("set_id") == F.col("s"))
    chosen = chosen.select("set_id", F.col("rep.text_id").alias("t"), F.col("rep.doc_id").alias("d"))
    texts = rows.join(chosen, (F.col("text_id") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d")))
    grams = gram_sets(texts, n).dropDuplicates(["set_id"]).withColumnRenamed("set_id", "g")
    full = needed.join(grams, F.col("set_id") == F.col("g")).join(bands.drop("rep"), F.col("set_id") == F.col("s"))
    found = stored(
        full.select(*KEYS, "chunk", "band", "set_id", "grams", "bands", "copies")
        .repartition(*KEYS).sortWithinPartitions(*KEYS)
        .mapInArrow(_verified(width, threshold), "set_id binary, other binary, links bigint"),
        "links",
    )
    roots = components(found.select(F.col("set_id").alias("u"), F.col("other").alias("v")))
    links = found.groupBy(F.col("set_id").alias("l")).agg(F.sum("links").alias("links"))
    judged = (
        sets.select("set_id", "least_id", "copies")
        .join(roots, F.col("set_id") == F.col("node"), "left")
        .join(links, F.col("set_id") == F.col("l"), "left")
        .select(
            "set_id", "least_id", "copies", F.coalesce("root", "set_id").alias("root"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    classes = judged.groupBy(F.col("root").alias("r")).agg(F.min("least_id").alias("class_id"))
    named = judged.join(classes, F.col("root") == F.col("r")).select(
        F.col("set_id").alias("m"), "class_id", "n_links", "copies", "root"
    )
    return marks.join(named, F.col("set_id") == F.col("m"), "left").select(
        "doc_id", "text_id", F.when(F.col("m").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("bigint").alias("copies"), "root",
    )


def one_per_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The input rows that stay: of each class one with the smallest id; empty texts all stay.

    The smallest id and text are found by aggregation. Of rows that repeat both, one stays.
    """
    found = link_classes(docs, doc_id, text, **options)
    stay = (
        found.where("root is not null").groupBy("root").agg(F.min(F.struct("doc_id", "text_id")).alias("x"))
        .select(F.col("x.doc_id").alias("jaccard_keep_doc"), F.col("x.text_id").alias("jaccard_keep_text"))
    )
    body = text_of(text)
    key = F.md5(body.cast("binary"))
    told = docs.withColumn("jaccard_text_id", key)
    joined = told.join(stay, (F.col("jaccard_text_id") == F.col("jaccard_keep_text")) & F.col(doc_id).cast("bigint").eqNullSafe(F.col("jaccard_keep_doc")))
    kept = joined.dropDuplicates(["jaccard_text_id", doc_id]).select(*docs.columns)
    return kept.unionByName(docs.where(F.btrim(body, F.lit(" \t\n\x0b\x0c\r")) == ""))
