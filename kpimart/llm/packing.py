"""Best-fit packing by a grouping genetic algorithm on islands.

Documents longer than a sequence are cut into sequences and a rest. Full pieces
need no search. The others are dealt at random into groups of bounded size; a
group is packed on several islands. An individual is a list of sequences.
Crossover injects whole well-filled sequences of one parent into the other,
takes out the other's sequences that share a piece with them, and puts the
displaced pieces back by best fit. After each epoch every island's elite also
migrates to the next island, over a shuffle. The best island's packing stays.

Edge cases: a null or empty text is the end id alone; rows with equal ids are
packed as documents of their own; null ids stay null; an empty table gives no
rows; only the two named columns are read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpimart.llm.common import cut, table
from kpimart.llm.tokens import encoder

PIECES = "item long, doc_id long, piece int, start long, length long, ids binary"
SPAN = 1 << 40  # items of one partition


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """A row for each piece of at most ``capacity`` ids, with the ids; ``item`` numbers the pieces."""
    end = np.asarray([end_id], "<u4").tobytes()

    def pieces(batches):
        enc, item = encoder(tokenizer), TaskContext.get().partitionId() * SPAN
        for batch in batches:
            for at in range(0, len(batch), 500):
                some, rows = batch.iloc[at:at + 500], []
                for doc_id, text in zip(some["id"].array, some["text"].array, strict=True):
                    ids = enc.text(text) + end
                    for k, i in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[i:i + 4 * capacity]
                        rows.append((item, None if pd.isna(doc_id) else int(doc_id), k, i // 4, len(part) // 4, part))
                        item += 1
                out = pd.DataFrame(rows, columns=["item", "doc_id", "piece", "start", "length", "ids"])
                yield out.astype({"doc_id": "Int64"})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(pieces, PIECES)


def best_fit(bins: list[list[int]], free: list[int], items, size, capacity: int) -> None:
    """Put each item, in the order given, where it leaves the least room; opens bins as needed."""
    order = sorted((f, b) for b, f in enumerate(free))
    for i in items:
        at = bisect_left(order, (size[i], -1))
        if at == len(order):
            b = len(bins)
            bins.append([])
            free.append(capacity)
        else:
            b = order.pop(at)[1]
        bins[b].append(i)
        free[b] -= size[i]
        if free[b]:
            insort(order, (free[b], b))


def room(bins: list[list[int]], size, capacity: int) -> list[int]:
    return [capacity - sum(size[i] for i in b) for b in bins]


def cost(bins: list[list[int]], free: list[int], capacity: int) -> tuple[int, float]:
    """Fewer sequences first, then fuller ones among as many."""
    return len(bins), -sum((1 - f / capacity) ** 2 for f in free)


def crossover(one, other, size, capacity: int, rng) -> list[list[int]]:
    """Well-filled bins of ``other`` replace what they overlap in ``one``; best fit for the displaced."""
    free = room(other, size, capacity)
    full = sorted(range(len(other)), key=free.__getitem__)[:max(1, len(other) // 2)]
    take = [other[b] for b in rng.choice(full, max(1, len(full) // 4), replace=False)]
    inside = {i for b in take for i in b}
    kept = [b for b in one if inside.isdisjoint(b)]
    placed = inside.union(*kept)
    out = [list(b) for b in take + kept]
    lost = [i for b in one for i in b if i not in placed]
    best_fit(out, room(out, size, capacity), sorted(lost, key=lambda i: -size[i]), size, capacity)
    return out


def mutate(bins, size, capacity: int, rng) -> list[list[int]]:
    """Empty the loosest bins and a few others; best fit for what they held, larger pieces first."""
    free = room(bins, size, capacity)
    loose = set(sorted(range(len(bins)), key=lambda b: -free[b])[:max(1, len(bins) // 20)])
    loose |= set(rng.integers(0, len(bins), max(1, len(bins) // 50)).tolist())
    out = [list(b) for k, b in enumerate(bins) if k not in loose]
    lost = [i for k in loose for i in bins[k]]
    best_fit(out, room(out, size, capacity), sorted(lost, key=lambda i: -size[i]), size, capacity)
    return out


def evolve(size: list[int], elites, capacity: int, population: int, generations: int, rng) -> list[list[int]]:
    """The best packing found from ``elites`` (or, without any, from best fit over shuffled and sorted pieces)."""
    people = list(elites)
    ranked = sorted(range(len(size)), key=lambda i: -size[i])
    while len(people) < population:
        order = ranked
        if people:  # the larger half sorted, the rest in any order
            k = len(ranked) // 2
            order = ranked[:k] + [ranked[k:][i] for i in rng.permutation(len(ranked) - k)]
        bins: list[list[int]] = []
        best_fit(bins, [], order, size, capacity)
        people.append(bins)

    def key(p):
        return cost(p, room(p, size, capacity), capacity)

    people.sort(key=key)
    least = -(-sum(size) // capacity)
    for _ in range(generations):
        if len(people[0]) <= least:
            break
        a, b = rng.choice(min(3, len(people)), 2, replace=False)
        children = [crossover(people[a], people[b], size, capacity, rng), mutate(people[0], size, capacity, rng)]
        people = sorted(people + children, key=key)[:population]
    return people[0]


def pack(pieces: DataFrame, capacity: int, group_items: int = 2000, islands: int = 2, epochs: int = 2,
         population: int = 4, generations: int = 6, seed: int = 7) -> DataFrame:
    """item, sequence_id, offset for ``pieces`` (item, length, at most ``capacity``).

    ``pieces`` has to be a table that gives the same rows each time it is read.
    """
    full = pieces.filter(F.col("length") == capacity).select(
        "item", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.filter(F.col("length") < capacity).select("item", "length")
    groups = max(1, -(-rest.count() // group_items))
    people = rest.select(F.pmod(F.xxhash64(F.lit(seed), "item"), F.lit(groups)).alias("pack"),
                         F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                         F.lit(-1).alias("origin"), "item", "length", F.lit(-1).alias("bin"))
    shape = "pack long, island int, origin int, item long, length long, bin int, offset long, n_bins int, fill double"

    def epoch(number: int):
        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            group, island = int(key[0]), int(key[1])
            rng = np.random.default_rng([seed, number, group, island])
            pdf = pdf.sort_values(["origin", "item"], kind="stable")
            parts = [p for _, p in pdf.groupby("origin", sort=True)]
            items, size = parts[0]["item"].to_numpy(), parts[0]["length"].tolist()
            elites = []
            for p in parts if number else []:
                bins: dict[int, list[int]] = {}
                for i, b in enumerate(p["bin"]):
                    bins.setdefault(b, []).append(i)
                elites.append(list(bins.values()))
            best = evolve(size, elites, capacity, population, generations, rng)
            n, fill = cost(best, room(best, size, capacity), capacity)
            where, at = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
            for b, held in enumerate(best):
                begin = 0
                for i in held:
                    where[i], at[i] = b, begin
                    begin += size[i]
            out = pd.DataFrame({"pack": group, "island": island, "origin": island, "item": items, "length": size,
                                "bin": where, "offset": at, "n_bins": n, "fill": fill})
            if number + 1 == epochs or islands == 1:
                return out
            return pd.concat([out, out.assign(island=(island + 1) % islands)])  # the elite migrates
        return run

    for number in range(epochs):
        people = people.groupBy("pack", "island").applyInPandas(epoch(number), shape)
    people = cut(people, "islands")
    best = people.groupBy("pack").agg(F.min(F.struct("n_bins", "fill", "island")).alias("best"))
    chosen = people.join(best, "pack").filter(F.col("island") == F.col("best.island"))
    return full.unionByName(chosen.select("item", (F.col("pack") * (1 << 24) + F.col("bin")).alias("sequence_id"),
                                          "offset"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id",
                   text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, ids."""
    pieces = token_pieces(docs, tokenizer, end_id, capacity, id_col, text_col).withColumn("ids_crc32", F.crc32("ids"))
    pieces = cut(pieces if keep_ids else pieces.drop("ids"), "pieces")
    return pieces.join(pack(pieces, capacity), "item").drop("item")


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 0, 2048, keep_ids=False).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
