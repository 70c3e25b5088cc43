"""N-gram Jaccard join: count-vector R-trees over routed units, then exact verification.

1. A document is the set of its distinct word shingles (64-bit names). Equal sets are one class, joined by one
   representative, so copies are never paired.
2. Shingles are hashed into groups. Corpus totals of 65,536 groups (a fixed-size table over all documents) give
   a global order, rarest group first. Two sets of similarity >= t share one of the first n - ceil(t n) + 1
   shingles of either in this order, so routing a set by those shingles loses no link. The smallest
   representative of a routing shingle names the unit of its holders; a set lies in few units.
3. In a unit, counts over 256 groups are points of an R-tree whose nodes hold coordinate maxima and size ranges.
   The summed coordinate minima of a point and a node bound the overlap of any pair below it. Only sets with a
   surviving partner get their shingles shipped.
4. Surviving pairs are verified on whole sets. Pairs already connected in the unit are skipped, so a unit emits
   a spanning forest of its links and never all pairs. Units above ``UNIT_ROWS`` are dealt out as pairs of
   blocks that together compare every pair once.
5. Connected components of the links give each class, hence each document, its component.

Cases: null and empty texts, and texts without a word, have an empty set and link with nothing (component is the own
id); texts with fewer words than a shingle are one shingle; repeated rows and ids are separate documents;
null ids never become a component's name unless it has no other; other columns are ignored or carried
through; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.components import component_roots
from wardlens.llm.exchange import (
    PACKED_DDL,
    added_up,
    blobs_of,
    bucket_total,
    by_bucket,
    first_of_runs,
    id_bucket,
    packed_rows,
    packed_tables,
    tables_of,
    task_group,
    text_batches,
    unpacked,
    written,
)
from wardlens.llm.hashing import U64, set_digest, shingle_set
from wardlens.llm.shipping import ship_package
from wardlens.llm.task_cache import release

WORDS = 5
PERCENT = 80
GROUPS = 1 << 16
SLICES = 64
COORDINATES = 256
FANOUT = 16
UNIT_ROWS = 1024
UNIT_SHINGLES = 2_000_000


def _group(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U64(48)).astype(np.int64)


def count_vector(hashes: np.ndarray) -> np.ndarray:
    """Counts of the set's shingles over ``COORDINATES`` hash groups, in the smallest sufficient type."""
    counts = np.bincount((hashes % U64(COORDINATES)).astype(np.int64), minlength=COORDINATES)
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def _vector(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"u{len(blob) // COORDINATES}").astype(np.int64)


def _count_groups(words: int):
    """Totals of the shingle groups over a task's documents, as ``SLICES`` packed rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        totals = np.zeros(GROUPS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                totals += np.bincount(_group(shingle_set(text.as_py(), words)), minlength=GROUPS)
        parts = totals.reshape(SLICES, -1)
        yield from packed_rows((task_group(), s, part.tobytes()) for s, part in enumerate(parts)).to_batches()

    return run


def _add_slices(table: pa.Table) -> pa.Table:
    blobs = table.column("data").to_pylist()
    if not blobs:
        return packed_rows([])
    total = np.sum([np.frombuffer(b, np.int64) for b in blobs], axis=0)
    return packed_rows([(0, table.column("bucket")[0].as_py(), total.tobytes())])


def group_totals(texts: DataFrame, words: int = WORDS) -> np.ndarray:
    """How many documents' shingles fall into each of the ``GROUPS`` groups; 512 KB whatever the corpus."""
    counted = added_up(texts.mapInArrow(_count_groups(words), PACKED_DDL), _add_slices)
    totals = np.zeros((SLICES, GROUPS // SLICES), np.int64)
    for row in counted.collect():
        totals[row["bucket"]] = np.frombuffer(row["data"], np.int64)
    return totals.ravel()


def routing_shingles(hashes: np.ndarray, totals: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles in the global order; any set with similarity >= percent shares one of them."""
    n = len(hashes)
    size = n - -(-percent * n // 100) + 1 if n else 0
    return hashes[np.lexsort((hashes, totals[_group(hashes)]))[:size]]


_SETS_DDL = "doc_id long, text_key long, n_shingles long, s1 long, s2 long, route binary, counts binary"


def _describe(words: int, percent: int, totals: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in text_batches(batches):
            sizes, first, second, routes, counts = [], [], [], [], []
            for text in batch.column("_text"):
                hashes = shingle_set(text.as_py(), words)
                a, b = set_digest(hashes)
                sizes.append(len(hashes))
                first.append(a)
                second.append(b)
                routes.append(routing_shingles(hashes, totals, percent).tobytes())
                counts.append(count_vector(hashes).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"), batch.column("_key"), pa.array(sizes, pa.int64()),
                    pa.array(first, pa.int64()), pa.array(second, pa.int64()),
                    pa.array(routes, pa.binary()), pa.array(counts, pa.binary()),
                ],
                names=["doc_id", "text_key", "n_shingles", "s1", "s2", "route", "counts"],
            )

    return run


def _route(total: int):
    """(shingle, row) entries, packed by shingle bucket; of equal sets in a batch only the smallest row's.

    A batch need not be in row order, and the class's representative, its smallest row, must be routed.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            least: dict[tuple[int, int], tuple[int, bytes]] = {}
            for row, a, b, route in zip(*(batch.column(c).to_pylist() for c in ("row", "s1", "s2", "route"))):
                if (a, b) not in least or row < least[a, b][0]:
                    least[a, b] = row, route
            rows, routes = zip(*sorted(least.values()))
            routes = [np.frombuffer(r, U64) for r in routes]
            shingle = np.concatenate(routes)
            node = np.repeat(np.array(rows, "i8"), [len(r) for r in routes])
            yield from packed_rows(
                by_bucket(0, (shingle % U64(total)).astype(np.int64), (shingle, node))
            ).to_batches()

    return run


_EDGES = pa.schema([("center", pa.int64()), ("node", pa.int64())])


def _units(total: int):
    """(center, row), packed by row bucket: holders of a shingle that has several, under the smallest of them.

    Equal sets hold the same shingles, so the smallest holder is always its class's representative.
    """

    def run(table: pa.Table) -> pa.Table:
        pairs = _held_pairs(table)
        return packed_rows(by_bucket(0, id_bucket(pairs[:, 1], total), (pairs[:, 0], pairs[:, 1])))

    return run


def _held_pairs(table: pa.Table) -> np.ndarray:
    shingle, node = unpacked(table.column("data").to_pylist(), ("u8", "i8"))
    order = np.lexsort((node, shingle))
    shingle, node = shingle[order], node[order]
    first = first_of_runs(shingle)
    run = np.cumsum(first) - 1
    several = np.bincount(run, minlength=1)[run] > 1 if len(run) else np.zeros(0, bool)
    center = node[first][run] if len(run) else node
    return np.unique(np.stack([center[several], node[several]], axis=1), axis=0)


def _distinct_units(table: pa.Table) -> pa.Table:
    """A set shares many shingles with its center, in many buckets; each pair stays once."""
    pairs = np.stack(unpacked(table.column("data").to_pylist(), ("i8", "i8")), axis=1)
    pairs = np.unique(pairs, axis=0)
    return pa.Table.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=_EDGES)


class CountTree:
    """R-tree over count vectors, packed by set size: nodes hold coordinate maxima and the range of sizes."""

    def __init__(self, sizes: np.ndarray, vectors: np.ndarray, percent: int):
        self.percent = percent
        self.levels = [(vectors, sizes, sizes)]
        while len(self.levels[-1][0]) > FANOUT:
            tops, low, high = self.levels[-1]
            at = np.arange(0, len(tops), FANOUT)
            self.levels.append(
                (np.maximum.reduceat(tops, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at))
            )

    def partners(self, n: int, vector: np.ndarray) -> np.ndarray:
        """Positions of the points whose bounds do not rule out a similarity of ``percent``."""
        p = self.percent
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            tops, low, high = self.levels[depth]
            at = at[(100 * high[at] >= p * n) & (100 * n >= p * low[at])]
            bound = np.minimum(tops[at], vector).sum(axis=1)
            # |A and B| >= p/100 |A or B|  <=>  (100 + p) |A and B| >= p (|A| + |B|)
            at = at[(100 + p) * bound >= p * (n + low[at])]
            if depth:
                at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                at = at[at < len(self.levels[depth - 1][0])]
        return at


def _candidates(sizes, vectors, blocks, same: bool, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per point (sorted by size) its later partners; across blocks only when the unit is a pair of blocks."""
    tree = CountTree(sizes, vectors, percent)
    for i in range(len(sizes) - 1):
        at = tree.partners(int(sizes[i]), vectors[i])
        at = at[at > i]
        if not same:
            at = at[blocks[at] != blocks[i]]
        if len(at):
            yield i, at


def _by_unit(table: pa.Table) -> Iterator[pa.Table]:
    """The rows of each (center, low, high) unit in a bucket, sorted by size and node."""
    table = table.sort_by([(c, "ascending") for c in ("center", "low", "high", "n_shingles", "node")])
    keys = [table.column(c).to_numpy() for c in ("center", "low", "high")]
    first = np.logical_or.reduce([first_of_runs(k) for k in keys]) if table.num_rows else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
        yield table.slice(a, b - a)


def _prune(percent: int):
    """Members with at least one partner that the tree does not rule out."""

    def run(table: pa.Table) -> pa.Table:
        kept = []
        for unit in _by_unit(table):
            sizes, blocks = unit.column("n_shingles").to_numpy(), unit.column("block").to_numpy()
            vectors = np.stack([_vector(v) for v in unit.column("counts").to_pylist()])
            hit = np.zeros(len(sizes), bool)
            same = unit.column("low")[0].as_py() == unit.column("high")[0].as_py()
            for i, at in _candidates(sizes, vectors, blocks, same, percent):
                hit[i] = True
                hit[at] = True
            if hit.any():
                kept.append(unit.drop_columns(["counts", "bucket"]).filter(pa.array(hit)))
        empty = table.drop_columns(["counts", "bucket"]).slice(0, 0)
        return pa.concat_tables([empty, *kept]).combine_chunks()

    return run


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _link(words: int, percent: int):
    """A spanning forest of the verified links of each unit."""

    def run(table: pa.Table) -> pa.Table:
        links = []
        for unit in _by_unit(table):
            nodes = unit.column("node").to_numpy()
            _, once = np.unique(nodes, return_index=True)
            unit = unit.take(np.sort(once))
            nodes = unit.column("node").to_pylist()
            blocks = unit.column("block").to_numpy()
            sets = [shingle_set(_shipped_text(t), words) for t in unit.column("text").to_pylist()]
            sizes = np.array([len(s) for s in sets])
            vectors = np.stack([count_vector(s).astype(np.int64) for s in sets])
            same = unit.column("low")[0].as_py() == unit.column("high")[0].as_py()
            parent = list(range(len(sets)))

            def root(x: int) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for i, at in _candidates(sizes, vectors, blocks, same, percent):
                for j in at.tolist():
                    if root(i) == root(j):
                        continue
                    both = overlap(sets[i], sets[j])
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        parent[root(j)] = root(i)
                        links.append((nodes[i], nodes[j]))
        left, right = zip(*links) if links else ((), ())
        return pa.Table.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["u", "v"])

    return run


WANTED, TEXTS = 1, 2
_SHIPPED_DDL = "center long, low int, high int, node long, n_shingles long, block int, bucket int, text binary"


def _attach_texts(table: pa.Table) -> pa.Table:
    """Of one bucket of documents: the wanted unit members with their compressed texts."""
    codec = pa.Codec("zstd")
    wanted = list(tables_of(blobs_of(table, WANTED)))
    wanted = pa.concat_tables(wanted) if wanted else _NOBODY
    keys = list(zip(wanted.column("_id").to_pylist(), wanted.column("_key").to_pylist()))
    asked, found = set(keys), {}
    for docs in tables_of(blobs_of(table, TEXTS)) if asked else ():
        texts = docs.column("_text")
        for n, key in enumerate(zip(docs.column("_id").to_pylist(), docs.column("_key").to_pylist())):
            if key in asked and key not in found:
                text = (texts[n].as_py() or "").encode("utf-8", "surrogatepass")
                found[key] = len(text).to_bytes(8, "little") + codec.compress(text, asbytes=True)
    return wanted.drop_columns(["_id", "_key"]).append_column("text", pa.array([found[k] for k in keys], pa.binary()))


_NOBODY = pa.table({
    **{c: pa.array([], pa.int64()) for c in ("center", "node", "n_shingles", "_id", "_key")},
    **{c: pa.array([], pa.int32()) for c in ("low", "high", "block", "bucket")},
}).select(["center", "low", "high", "node", "n_shingles", "block", "bucket", "_id", "_key"])


def _shipped_text(blob: bytes) -> str:
    size = int.from_bytes(blob[:8], "little")
    return pa.Codec("zstd").decompress(blob[8:], size, asbytes=True).decode("utf-8", "surrogatepass") if size else ""


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("`text`")
    return docs.select(
        F.col("`doc_id`").cast("long").alias("_id"), F.xxhash64(text).alias("_key"), text.alias("_text")
    )


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, text_key, n_shingles, component_id and kept (one document per component)."""
    spark, total = docs.sparkSession, bucket_total(docs.sparkSession)
    ship_package(spark)
    keyed = _keyed(docs)
    totals = group_totals(keyed.select("_text"), words)
    described = keyed.mapInArrow(_describe(words, percent, totals), _SETS_DDL)
    sets = written(described.withColumn("row", F.monotonically_increasing_id()), "sets")

    classes = sets.where("n_shingles > 0").groupBy("s1", "s2").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("least"),
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("front"),
    )
    classes = written(classes, "classes")
    routed = sets.where("n_shingles > 0").select("row", "s1", "s2", "route")
    held = routed.mapInArrow(_route(total), PACKED_DDL).groupBy("bucket").applyInArrow(_units(total), PACKED_DDL)
    pairs = held.groupBy("bucket").applyInArrow(_distinct_units, "center long, node long")
    edges = written(pairs.join(classes.select("node"), "node", "left_semi").select("center", "node"), "units")

    links = written(_links(docs, sets, edges, total, words, percent), "links")
    roots = component_roots(links).select(F.col("u").alias("node"), F.col("v").alias("root"))
    placed = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    components = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.min("front").alias("front"))
    labelled = placed.select("s1", "s2", "root").join(components, "root").select(
        "s1", "s2", "component_id", F.col("front.row").alias("front")
    )
    out = sets.select("row", "doc_id", "text_key", "n_shingles", "s1", "s2").join(labelled, ["s1", "s2"], "left")
    alone = F.col("n_shingles") == 0
    return out.select(
        "doc_id", "text_key", "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | (F.col("front") == F.col("row"))).alias("kept"),
    )


def _links(docs: DataFrame, sets: DataFrame, edges: DataFrame, total: int, words: int, percent: int) -> DataFrame:
    """Verified links between representatives, a spanning forest per unit."""
    points = sets.select(F.col("row").alias("node"), "n_shingles", "counts")
    members = edges.join(points, "node")
    sizes = edges.join(points.select("node", "n_shingles"), "node").groupBy("center").agg(
        F.greatest(
            F.ceil(F.count("*") / UNIT_ROWS), F.ceil(F.sum("n_shingles") / UNIT_SHINGLES), F.lit(1)
        ).cast("int").alias("blocks")
    ).where("blocks > 1")  # the few large units
    dealt = (
        members.join(sizes, "center", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "center", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "node", "n_shingles", "block", "counts",
        )
    )
    unit = F.pmod(F.xxhash64("center", "low", "high"), F.lit(total)).cast("int").alias("bucket")
    pruned = dealt.select("*", unit).groupBy("bucket").applyInArrow(
        _prune(percent), "center long, low int, high int, node long, n_shingles long, block int"
    )
    pruned = written(pruned, "pruned")
    wanted = pruned.select("*", unit).join(
        sets.select(F.col("row").alias("node"), F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")), "node"
    )
    home = F.pmod(F.xxhash64("_id", "_key"), F.lit(total)).cast("int").alias("home")
    members = wanted.select(
        "center", "low", "high", "node", "n_shingles", "block", "bucket", "_id", "_key", home
    ).mapInArrow(packed_tables(WANTED, "home"), PACKED_DDL)
    texts = _keyed(docs).select("*", home).mapInArrow(packed_tables(TEXTS, "home"), PACKED_DDL)
    shipped = texts.unionByName(members).groupBy("bucket").applyInArrow(_attach_texts, _SHIPPED_DDL)
    return shipped.groupBy("bucket").applyInArrow(_link(words, percent), "u long, v long").distinct()


def ngram_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the smallest id reachable by links of the similarity."""
    return jaccard_components(docs, words, percent).select("doc_id", "n_shingles", "component_id")


def one_per_component(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of the smallest id of each component, in its own columns; texts without a word all stay.

    Of rows that repeat id and text the smallest in all columns stays.
    """
    found = jaccard_components(docs, words, percent)
    keys = written(
        found.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
            F.max("kept").alias("kept"), ((F.max("n_shingles") > 0) & (F.count("*") > 1)).alias("several")
        ).where("kept"),
        "kept",
    )
    own_id, own_key = F.col("`doc_id`").cast("long"), F.xxhash64(F.col("`text`"))

    def held(keys: DataFrame) -> DataFrame:
        return docs.join(keys, own_id.eqNullSafe(keys["_id"]) & (own_key == keys["_key"]), "left_semi")

    several = keys.where("several").select("_id", "_key")
    if several.isEmpty():
        return held(keys.select("_id", "_key"))
    fields = [F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(docs.columns)]
    least = held(several).groupBy(own_id.alias("_id"), own_key.alias("_key")).agg(F.min(F.struct(*fields)).alias("row"))
    once = least.select(*[F.col(f"row.c{n}").alias(c) for n, c in enumerate(docs.columns)])
    return held(keys.where("not several").select("_id", "_key")).union(once)
