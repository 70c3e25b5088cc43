"""Best-fit packing of tokenised documents by a grouping genetic algorithm on migrating islands.

1. Tasks tokenise whole texts (pre-token ids are the library's; a bounded number is remembered) and cut documents
   above the capacity into full pieces after a shorter first one. Only piece lengths travel from here on.
2. Full pieces are sequences by themselves. The others are dealt by hash to shards of about ``SHARD`` pieces, a
   bounded problem each. Every shard lives on ``ISLANDS`` islands: populations of complete packings.
3. A generation crosses two packings: whole well-filled bins of one are injected into the other, bins that would then hold a
   piece twice are dissolved, and the displaced pieces are placed by best fit, longest first. Mutation dissolves the
   emptiest bins. Fewer bins win, then the larger sum of squared fills.
4. After each of ``EPOCHS`` epochs an island's best packings move to the next island of the ring, as rows of a join.
5. Bins of the best packing below ``DENSE`` of the capacity, the emptiest first and with at most half of the pieces, are
   dissolved and dealt to fewer shards, until one shard is left, so the shards' last bins are filled across shards.

Cases: null and empty texts have no own token, just the end id; rows that repeat an id or a text are packed each; a document of
exactly the capacity is not cut; other columns are ignored; an empty table gives an empty result. Equal
packings are resolved by island number, and seeds come from shard and island, so a rerun gives the same result.
"""

from __future__ import annotations

import random
import struct
import zlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlens.llm.exchange import bucket_total, text_batches, written
from wardlens.llm.pretokens import PreTokens, Rules, merged, prove_rules
from wardlens.llm.shipping import ship_package
from wardlens.llm.task_cache import held

CAPACITY = 2048
END_ID = 0
SHARD = 4096
ISLANDS = 3
EPOCHS = 2
POPULATION = 4
GENERATIONS = 3
ELITES = 2
DENSE = 0.95
MEMO = 400_000
_PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, rules: Rules):
        self.split = PreTokens(rules)
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        parts: list[bytes] = []
        for run in self.split.of(text):
            if isinstance(run, int):
                parts.append(run.to_bytes(4, "little"))
                continue
            known = self.known
            found = list(map(known.get, run))
            if None in found:
                new = list({p for p, ids in zip(run, found) if ids is None})
                merges = {p: struct.pack(f"<{len(i)}I", *i) for p, i in zip(new, merged(self.split.piece, new))}
                if len(known) + len(merges) <= MEMO:
                    known.update(merges)
                found = [merges[p] if ids is None else ids for p, ids in zip(run, found)]
            parts += found
        return b"".join(parts)


def cuts(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: a shorter first one if needed, then full ones."""
    first = length % capacity
    starts = [0] if first else []
    starts += range(first, length, capacity)
    return [(s, min(capacity, length - s) if s or not first else first) for s in starts]


def _tokenise(shared, capacity: int):
    end = END_ID.to_bytes(4, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held(shared.value, Encoder)
        for batch in text_batches(batches):
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = memoryview(encoder.encode(text.as_py() or "") + end)
                for n, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    out.append((doc, n, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


Packing = list[list[int]]


class Bins:
    """Open bins by free space; the tightest that fits is found in a bit set."""

    def __init__(self, sizes: Sequence[int], capacity: int, packing: Packing = ()):
        self.sizes, self.capacity = sizes, capacity
        self.by_free: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
        self.all: Packing = list(packing)
        for items in packing:
            self.by_free[capacity - sum(map(sizes.__getitem__, items))].append(items)
        self.mask = sum(1 << free for free, items in enumerate(self.by_free) if free and items)

    def place(self, pieces: Iterable[int]) -> Packing:
        sizes, by_free, mask = self.sizes, self.by_free, self.mask
        for i in pieces:
            size = sizes[i]
            fits = mask >> size
            if fits:
                free = size + (fits & -fits).bit_length() - 1
                same = by_free[free]
                items = same.pop()
                if not same:
                    mask ^= 1 << free
                items.append(i)
                free -= size
            else:
                items = [i]
                self.all.append(items)
                free = self.capacity - size
            if free:
                same = by_free[free]
                if not same:
                    mask |= 1 << free
                same.append(items)
        self.mask = mask
        return self.all


class Island:
    """A population of packings of one shard."""

    def __init__(self, sizes: Sequence[int], capacity: int, seed: int):
        self.sizes, self.capacity, self.random = sizes, capacity, random.Random(seed)
        self.longest_first = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
        self.place_in_order = {i: n for n, i in enumerate(self.longest_first)}

    def fitness(self, packing: Packing) -> tuple[int, int]:
        size = self.sizes.__getitem__
        return -len(packing), sum([sum(map(size, items)) ** 2 for items in packing])

    def best_fit(self, pieces: Iterable[int], packing: Packing = ()) -> Packing:
        return Bins(self.sizes, self.capacity, packing).place(pieces)

    def newcomer(self) -> Packing:
        """Best fit over a slightly disturbed order."""
        keys = {i: self.sizes[i] * self.random.uniform(0.9, 1.0) for i in self.longest_first}
        return self.best_fit(sorted(self.longest_first, key=lambda i: (-keys[i], i)))

    def cross(self, host: Packing, donor: Packing) -> Packing:
        size = self.sizes.__getitem__
        filled = sorted(donor, key=lambda items: (-sum(map(size, items)), items[0]))
        filled = filled[: max(1, len(filled) // 3)]
        injected = self.random.sample(filled, max(1, len(filled) // 2))
        inside = {i for items in injected for i in items}
        child, displaced = [list(items) for items in injected], []
        rest = []
        for items in host:
            if inside.isdisjoint(items):
                rest.append(items)
            else:
                displaced += [i for i in items if i not in inside]
        rest.sort(key=lambda items: (sum(map(size, items)), items[0]))
        for items in rest[:2]:  # mutation: the emptiest bins are dissolved too
            displaced += items
        child += [list(items) for items in rest[2:]]
        displaced.sort(key=self.place_in_order.__getitem__)
        return self.best_fit(displaced, child)

    def evolve(self, population: list[Packing]) -> list[Packing]:
        population = list(population)
        if not population:
            population.append(self.best_fit(self.longest_first))
        lower_bound = -(-sum(self.sizes) // self.capacity)
        while len(population) < POPULATION:
            population.append(self.newcomer())
        fittest_first = {"key": lambda scored: scored[0], "reverse": True}
        scored = sorted(((self.fitness(p), p) for p in population), **fittest_first)
        for _ in range(GENERATIONS):
            population = [p for _, p in scored]
            if len(population[0]) == lower_bound:
                break  # no packing has fewer bins
            children = [self.cross(*self.random.sample(population, 2)) for _ in range(POPULATION // 2)]
            scored = sorted([*scored, *((self.fitness(p), p) for p in children)], **fittest_first)[:POPULATION]
        return [p for _, p in scored[:ELITES]]


def _numbers(packing: Packing, count: int) -> list[int]:
    """Bin number of each piece."""
    out = [0] * count
    for n, items in enumerate(packing):
        for i in items:
            out[i] = n
    return out


def _packing(numbers: Sequence[int]) -> Packing:
    out: Packing = [[] for _ in range(max(numbers) + 1)]
    for i, n in enumerate(numbers):
        out[n].append(i)
    return out


def _evolve(capacity: int, epoch: int, level: int):
    """(shard, island, lengths, residents) -> (shard, island, rank, bins, squares, numbers)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                seed = zlib.crc32(f"{level}|{epoch}|{row['shard']}|{row['island']}".encode())
                island = Island(row["lengths"], capacity, seed)
                best = island.evolve([_packing(r) for r in row["residents"]])
                out = [
                    (row["shard"], row["island"], rank, *island.fitness(p), _numbers(p, len(row["lengths"])))
                    for rank, p in enumerate(best)
                ]
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                    names=["shard", "island", "rank", "bins", "squares", "numbers"],
                )

    return run


_ELITE_DDL = "shard long, island int, rank int, bins int, squares long, numbers array<int>"


def _pack_level(items: DataFrame, capacity: int, level: int, shards: int) -> DataFrame:
    """(uid, length, shard, bin) of the best packing of each shard."""
    spark = items.sparkSession
    tasks = max(1, min(shards * ISLANDS, bucket_total(spark)))
    member = F.sort_array(F.collect_list(F.struct("length", "uid")))
    problems = items.groupBy(F.pmod(F.xxhash64(F.lit(level), "uid"), F.lit(shards)).alias("shard")).agg(
        member.alias("members")
    )
    problems = written(
        problems.select("shard", F.col("members.uid").alias("uids"), F.col("members.length").cast("array<int>").alias("lengths")),
        "shards",
    )
    islands = problems.select("shard", "lengths").withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    nobody = F.lit([]).cast("array<array<int>>")
    elites = None
    for epoch in range(EPOCHS):
        if elites is None:
            inhabited = islands.withColumn("residents", nobody)
        else:
            home = F.col("island")
            moved = F.when(F.col("rank") == 0, F.array(home, (home + 1) % ISLANDS)).otherwise(F.array(home))
            residents = elites.select("shard", F.explode(moved).alias("island"), "rank", "bins", "numbers").groupBy(
                "shard", "island"
            ).agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "bins", "numbers"))), lambda r: r["numbers"]).alias("residents"))
            inhabited = islands.join(residents, ["shard", "island"])
        evolved = inhabited.repartition(tasks, "shard", "island").mapInArrow(
            _evolve(capacity, epoch, level), _ELITE_DDL
        )
        elites = written(evolved, "elites")
    best = elites.groupBy("shard").agg(
        F.max_by("numbers", F.struct("bins", "squares", -F.col("island"), -F.col("rank"))).alias("numbers")
    )
    packed = problems.join(best, "shard").select("shard", F.explode(F.arrays_zip("uids", "lengths", "numbers")).alias("m"))
    return packed.select(
        F.col("m.uids").alias("uid"), F.col("m.lengths").cast("long").alias("length"), "shard", F.col("m.numbers").alias("bin")
    )


def _emptiest(packed: DataFrame, capacity: int, level: int, room: int) -> DataFrame:
    """(shard, bin) of the emptiest bins below ``DENSE`` that hold about ``room`` pieces at most.

    Of the bins of the last fill that has room a part is drawn by hash.
    """
    fills = packed.groupBy("shard", "bin").agg(F.sum("length").alias("fill"), F.count("*").alias("pieces"))
    fills = fills.where(F.col("fill") < DENSE * capacity)
    parts = 1 << 20
    for row in fills.groupBy("fill").agg(F.sum("pieces").alias("pieces")).orderBy("fill").collect():
        if row["pieces"] > room:
            number = F.pmod(F.xxhash64(F.lit(level), "shard", "bin"), F.lit(parts))
            drawn = (F.col("fill") < row["fill"]) | (
                (F.col("fill") == row["fill"]) & (number < parts * room // row["pieces"])
            )
            break
        room -= row["pieces"]
    else:
        drawn = F.lit(True)
    return fills.where(drawn).select("shard", "bin")


def pack_pieces(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(uid, sequence_id, offset) for pieces (uid, length) shorter than the capacity; sequence ids are odd."""
    done, level, count = None, 0, items.count()
    shards = -(-count // SHARD)
    while count:
        packed = written(_pack_level(items, capacity, level, shards), "packed")
        loose = _emptiest(packed, capacity, level, count // 2)
        again = written(packed.join(loose, ["shard", "bin"], "left_semi").select("uid", "length"), "loose")
        left = again.count()
        last = shards == 1 or left == 0
        final = packed if last else packed.join(again.select("uid"), "uid", "left_anti")
        final = final.withColumn("level", F.lit(level).cast("long"))
        done = final if done is None else done.unionByName(final)
        if last:
            break
        items, count, level = again, left, level + 1
        shards = min(-(-count // SHARD), shards - 1)
    if done is None:
        return items.select("uid", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    before = Window.partitionBy("level", "shard", "bin").orderBy(F.desc("length"), "uid").rowsBetween(
        Window.unboundedPreceding, -1
    )
    number = ((F.col("level") * (1 << 36) + F.col("shard")) * (2 * SHARD) + F.col("bin")) * 2 + 1
    return done.select("uid", number.alias("sequence_id"), F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))


def tokenised_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY) -> DataFrame:
    """(uid, doc_id, piece, start, length, ids_crc32), written."""
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer_file, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(prove_rules(file.read()))
    read = docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`text`").alias("text"))
    pieces = read.mapInArrow(_tokenise(shared, capacity), _PIECES_DDL)
    return written(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    pieces = tokenised_pieces(docs, tokenizer_file, capacity)
    full = pieces.where(F.col("length") == capacity).select(
        "*", (F.col("uid") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    open_pieces = pieces.where(F.col("length") < capacity)
    placed = pack_pieces(open_pieces.select("uid", "length"), capacity)
    return full.unionByName(open_pieces.join(placed, "uid")).drop("uid")
