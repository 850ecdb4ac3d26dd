"""Phrase collocation mining by dynamic itemset counting.

The texts are coded once into blocks of word numbers, dealt over a few shards.
Shards are then scanned in a cycle, and phrases of all lengths are counted in
the same scan: words from the first step, a longer phrase from the step after
both its parts (all but its last word, all but its first) have reached the
threshold in what was scanned so far. Each phrase is counted through one full
cycle from where it started, so its count is exact, and then leaves the scans.

What the scans need of the phrases that reached the threshold is the step at
which they did. It is kept in a table of fixed size (``slots`` bytes, by hash),
which is broadcast; two phrases that share a slot start some phrases too early,
never too late, so this costs some work and no result. Counts themselves are
kept by the phrase's own words, in Spark tables.

Almost every phrase of a scan is a rare one, so counts do not travel as a row
each: a scan sends a pack (an Arrow batch) for each bucket of phrases, dealt by
hash, and a bucket's packs are summed in Arrow. There are as many buckets as
keep each to some ``BUCKET_WORDS`` scanned words.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpimart.llm.common import cut, discard, new_folder, table

LONGEST = 4
SHARDS = 4
SLOTS = 1 << 23
NEVER = 255
BLOCK_WORDS = 1 << 18   # coded words a block
HELD_WORDS = 1 << 21    # coded words a task holds over all its open blocks, or counts at once
BREAK = b"\xff"         # in no UTF-8 text; word number 0

BLOCKS = "shard int, lang string, n_words long, words binary, codes binary"
BUCKET_WORDS = 1 << 18  # scanned words a bucket of counts
LEAST_BUCKETS = 64
SENT_BYTES = 1 << 23    # of packs at a time

# A pack: the key is the phrase, a tab (no word holds one) and the language; start is the step its cycle began.
PACK = pa.schema([("key", pa.binary()), ("slot", pa.int32()), ("start", pa.uint8()), ("length", pa.uint8()), ("n", pa.int64())])
PACKS = "bucket int, packed binary"
# A step's sums: packs of the phrases it saw often and seldom, of those whose cycle ended with enough, and the
# slots (int32) of those that reached the threshold.
SUMS = "start int, bucket int, often binary, seldom binary, settled binary, slots binary"
COUNTS = "key string, length int, n long"

# Lower case for A-Z, one blank for a tab, a break for the marks that end pieces.
_FOLD = bytes.maketrans(bytes(range(65, 91)) + b"\t" + b".,;:!?\n\x0b\x0c\r", bytes(range(97, 123)) + b" " + BREAK * 10)


class _Numbers(dict):
    """Word to number, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Block:
    def __init__(self):
        self.numbers, self.codes, self.n_words = _Numbers({BREAK: 0}), array("I"), 0

    def add(self, text: bytes) -> int:
        words = (text.translate(_FOLD) + BREAK).replace(BREAK, b" \xff ").split()
        self.codes.extend(map(self.numbers.__getitem__, words))
        self.n_words += len(words) - words.count(BREAK)
        return len(words)


def code_blocks(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` (lang, text) as blocks of word numbers with their words, dealt over ``shards``."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        names = ["shard", "lang", "n_words", "words", "codes"]
        open_blocks: dict[tuple[str, int], _Block] = {}
        held, turn = 0, TaskContext.get().partitionId()

        def close(key) -> pa.RecordBatch:
            b = open_blocks.pop(key)
            codes = np.frombuffer(b.codes, np.uint32)
            if len(b.numbers) <= 1 << 16:
                codes = codes.astype(np.uint16)
            values = [[key[1]], [key[0]], [b.n_words], [b" ".join(b.numbers)], [codes.tobytes()]]
            types = [pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                turn += 1
                key = (lang, turn % shards)
                block = open_blocks.setdefault(key, _Block())
                held += block.add(text.as_py())
                if len(block.codes) >= BLOCK_WORDS:
                    held -= len(block.codes)
                    yield close(key)
                elif held >= HELD_WORDS:
                    yield from map(close, list(open_blocks))
                    held = 0
        yield from map(close, list(open_blocks))

    return docs.mapInArrow(blocks, BLOCKS)


def _factors() -> list[np.ndarray]:
    """Odd multipliers by length and place, so that word order and length count in a hash."""
    draw = np.random.default_rng(13)
    return [draw.integers(1, 1 << 63, k, np.uint64) * np.uint64(2) + np.uint64(1) for k in range(1, LONGEST + 1)]


def _slot(hashes: np.ndarray, slots: int) -> np.ndarray:
    """The place of hashes in a table of ``slots``, a power of two; it grows with the hash."""
    return hashes >> np.uint64(64 - (slots.bit_length() - 1))


def _changes(columns: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it in ``order``; the first does."""
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in columns:
        ordered = column[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    return new


def _grouped(hashes: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order by hash in which equal rows of ``columns`` are neighbours, and where in it each distinct row begins."""
    order = np.argsort(hashes)
    new = _changes(columns, order)
    if (new & ~_changes([hashes], order)).any():  # different rows of one hash
        order = np.lexsort([*columns, hashes])
        new = _changes(columns, order)
    return order, np.flatnonzero(new)


class _Scan:
    """Counts one step's phrases in coded words of one language."""

    def __init__(self, step: int, shards: int, longest: int, buckets: int, reached: np.ndarray):
        self.step, self.shards, self.longest, self.buckets, self.reached = step, shards, longest, buckets, reached
        self.factors = _factors()

    def counts(self, lang: str, words: list[bytes], codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        seed = xxh64_intdigest(lang.encode())
        own = np.fromiter((xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))
        names = pa.array(words, pa.binary())
        at = np.flatnonzero(codes)                     # where phrases of this length begin
        start = np.zeros(len(at), np.int16)            # the step their counting began
        for k in range(1, self.longest + 1):
            hashes = np.zeros(len(at), np.uint64)
            for j, factor in enumerate(self.factors[k - 1]):
                hashes += own[codes[at + j]] * factor
            yield from self.rows(lang, k, names, codes, at, start, hashes)
            if k == self.longest:
                return
            # The next length begins where two of this one overlap, and from the later one's step on; a slot
            # that another phrase filled must not put its start before the phrase's own.
            when = self.reached[_slot(hashes, len(self.reached))].astype(np.int16)
            if k == 1:
                when[:] = self.reached[_slot(own * self.factors[0][0], len(self.reached))][codes[at]]
            known = when <= self.step
            at, when = at[known], np.maximum(when, start)[known]
            pairs = np.flatnonzero(np.diff(at) == 1)
            start = np.maximum(when[pairs], when[pairs + 1])
            at = at[pairs]

    def rows(self, lang, k, names, codes, at, start, hashes) -> Iterator[pa.RecordBatch]:
        """Distinct phrases still in their cycle, with their counts, in packs by bucket."""
        due = start > self.step - self.shards
        if not due.any():
            return
        at, start, hashes = at[due], start[due], hashes[due]
        order, first = _grouped(hashes, [codes[at + j] for j in range(k)])
        times = np.diff(first, append=len(at))
        first = order[first]
        at, start, hashes = at[first], start[first], hashes[first]
        phrase = names.take(pa.array(codes[at]))
        if k > 1:
            phrase = pc.binary_join_element_wise(phrase, *[names.take(pa.array(codes[at + j])) for j in range(1, k)], b" ")
        phrase = pc.binary_join_element_wise(phrase, pa.scalar(lang.encode(), pa.binary()), b"\t")
        counts = _batch(PACK, [phrase, _slot(hashes, len(self.reached)).astype(np.int32), start.astype(np.uint8),
                               np.full(len(at), k, np.uint8), times.astype(np.int64)])
        ends = np.searchsorted(_slot(hashes, self.buckets), np.arange(self.buckets, dtype=np.uint64), "right")
        packs, size, low = ([], []), 0, 0
        for bucket, high in enumerate(ends.tolist()):
            if high > low:
                pack = counts.slice(low, high - low).serialize()
                packs[0].append(bucket)
                packs[1].append(pack.to_pybytes())
                size += pack.size
            low = high
            if size >= SENT_BYTES or (packs[0] and bucket == self.buckets - 1):
                yield pa.RecordBatch.from_arrays([pa.array(packs[0], pa.int32()), pa.array(packs[1], pa.binary())],
                                                 ["bucket", "packed"])
                packs, size = ([], []), 0


def _batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _pack(counts: pa.Table) -> bytes | None:
    """The rows of ``counts`` as one pack; none if there are none."""
    if not counts.num_rows:
        return None
    return counts.combine_chunks().to_batches()[0].serialize().to_pybytes()


def _unpacked(packed: pa.BinaryScalar) -> pa.RecordBatch:
    return pa.ipc.read_record_batch(pa.py_buffer(packed.as_py()), PACK)


def _scan(blocks: DataFrame, step: int, shards: int, longest: int, buckets: int, reached) -> DataFrame:
    """Counts of the phrases that this step scans for, summed by task, in packs."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _Scan(step, shards, longest, buckets, np.frombuffer(reached.value, np.uint8))
        held: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
        size = 0

        def count(lang) -> Iterator[pa.RecordBatch]:
            numbers, parts = held.pop(lang)
            yield from scan.counts(lang, list(numbers), np.concatenate(parts).astype(np.int64))

        for batch in batches:
            for lang, words, codes in zip(*map(batch.column, ("lang", "words", "codes")), strict=True):
                lang, words, raw = lang.as_py(), words.as_py().split(b" "), codes.as_py()
                codes = np.frombuffer(raw, np.uint16 if len(words) <= 1 << 16 else np.uint32)
                numbers, parts = held.setdefault(lang, (_Numbers({BREAK: 0}), []))
                parts.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words))[codes])
                size += len(codes)
                if size >= HELD_WORDS:
                    for name in list(held):
                        yield from count(name)
                    size = 0
        for name in list(held):
            yield from count(name)

    return blocks.mapInArrow(counts, PACKS)


def _sums(packs: DataFrame, step: int, shards: int, longest: int, least: int) -> DataFrame:
    """``packs`` (bucket, packed, now: of this step's scan) of the phrases in their cycle, summed by bucket.

    Phrases whose cycle ends now are summed whole; the others' sums leave out
    what an earlier step saw seldom, so that a phrase rather starts later than
    that all rows are summed after each step.
    """
    names = [f.split()[0] for f in SUMS.split(", ")]
    types = [pa.int32(), pa.int32()] + [pa.binary()] * 4

    def close(bucket: int, held: list[tuple[pa.RecordBatch, bool]]) -> pa.RecordBatch:
        counts = pa.Table.from_batches([b for b, _ in held])
        now = pa.chunked_array([b.column("n") if new else pa.array(np.zeros(len(b), np.int64)) for b, new in held])
        counts = counts.append_column("now", now).combine_chunks().group_by("key", use_threads=False).aggregate(
            [("slot", "min"), ("start", "min"), ("length", "min"), ("n", "sum"), ("now", "sum")])
        key, slot, start, length, n, now = (counts.column(c) for c in (
            "key", "slot_min", "start_min", "length_min", "n_sum", "now_sum"))
        whole = pa.Table.from_arrays([key, slot, start, length, n], schema=PACK)
        fresh = pa.Table.from_arrays([key, slot, start, length, now], schema=PACK)
        slot, start, length, n, now = (c.to_numpy() for c in (slot, start, length, n, now))
        ended, enough = start == step - shards + 1, n >= least
        over = np.unique(slot[enough & (length < longest) & (ended | (n - now < least))])
        rows = []
        for first in np.unique(start).tolist():
            own, often = start == first, now > least // (2 * shards)
            row = [first, bucket, None, None, None, None]
            if first == step - shards + 1:
                row[4] = _pack(whole.filter(pa.array(own & enough)))
            else:
                row[2:4] = _pack(fresh.filter(pa.array(own & often))), _pack(fresh.filter(pa.array(own & ~often & (now > 0))))
            if not rows and len(over):
                row[5] = over.tobytes()
            rows.append(row)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for bucket, packed, now in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                if bucket != at and held:
                    yield close(at, held)
                    held = []
                at = bucket
                held.append((_unpacked(packed), now))
        if held:
            yield close(at, held)

    return packs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(sums, SUMS)


def _settled(sums: DataFrame) -> DataFrame:
    """The packs of phrases whose cycle ended with enough, as rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column(0):
                pack = _unpacked(packed)
                yield pa.RecordBatch.from_arrays([pack.column("key").cast(pa.string()), pack.column("length").cast(pa.int32()),
                                                  pack.column("n")], ["key", "length", "n"])

    return sums.filter("settled IS NOT NULL").select("settled").mapInArrow(rows, COUNTS)


def phrase_counts(docs: DataFrame, least: int = 30, longest: int = LONGEST, shards: int = SHARDS, slots: int = SLOTS
                  ) -> tuple[DataFrame, DataFrame]:
    """Every phrase of up to ``longest`` words that occurs ``least`` times in its language, and all words by language.

    ``docs`` holds lang and text, without nulls. Returns (lang, phrase, length,
    n) and (lang, n).
    """
    if slots & (slots - 1) or not 1 <= longest <= LONGEST:
        raise ValueError(f"slots is a power of two and longest at most {LONGEST}")
    spark = docs.sparkSession
    place = new_folder(spark, "phrase-blocks")
    code_blocks(docs.select("lang", F.col("text").cast("binary").alias("text")), shards).write.option(
        "compression", "zstd").partitionBy("shard").parquet(place)
    blocks = spark.read.schema(BLOCKS).parquet(place)
    words = cut(blocks.groupBy("lang").agg(F.sum("n_words").alias("n")), "phrase-words")
    scanned = (words.agg(F.sum("n")).first()[0] or 0) // shards
    buckets = 1 << max(LEAST_BUCKETS - 1, scanned // BUCKET_WORDS).bit_length()
    reached = np.full(slots, NEVER, np.uint8)
    folder = new_folder(spark, "phrase-steps")

    def sums(steps) -> DataFrame:
        return spark.read.schema(f"{SUMS}, step int").option("basePath", folder).parquet(*(f"{folder}/step={i}" for i in steps))

    for step in range(NEVER):
        # What reached the threshold in the last cycle is all that can have started phrases still in theirs.
        if step >= shards and not ((reached > step - shards) & (reached <= step)).any():
            break
        ending, earlier = step - shards + 1, range(max(0, step - shards + 1), step)
        told = spark.sparkContext.broadcast(reached.tobytes())
        seen = _scan(blocks.filter(F.col("shard") == step % shards), step, shards, longest, buckets, told)
        packs = seen.withColumn("now", F.lit(True))
        if earlier:
            kept = sums(earlier).filter(F.col("start") >= ending)
            for part in (kept.select("bucket", F.col("often").alias("packed")),
                         kept.filter(F.col("start") == ending).select("bucket", F.col("seldom").alias("packed"))):
                packs = packs.unionByName(part.filter("packed IS NOT NULL").withColumn("now", F.lit(False)))
        with _unsorted_folders(spark, shards):
            _sums(packs, step, shards, longest, least).write.partitionBy("start").parquet(f"{folder}/step={step}")
        told.unpersist()
        over = sums([step]).filter("slots IS NOT NULL").select("slots").toArrow().column("slots")
        for slot in over:
            new = np.frombuffer(slot.as_py(), np.int32)
            reached[new[reached[new] == NEVER]] = step + 1
        for i in earlier:
            discard(spark, f"{folder}/step={i}/start={ending}")
    else:
        raise RuntimeError("phrases were still being activated after all steps")
    counts = cut(_settled(sums(range(step))), "phrase-counts")
    discard(spark, folder)
    discard(spark, place)
    part = F.split("key", "\t", 2)
    return counts.select(part[1].alias("lang"), part[0].alias("phrase"), "length", "n"), words


@contextmanager
def _unsorted_folders(spark: SparkSession, n: int):
    """A write to at most ``n`` folders keeps a file of each open instead of sorting its rows by folder."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def collocations(counts: DataFrame, words: DataFrame, longest: int = LONGEST, top: int = 2000) -> DataFrame:
    """The best phrases of each language by :func:`phrase_counts`' results.

    A phrase of two words or more is cut after each word; ``l`` and ``r`` are
    the counts of both sides, the score is floor(2000000 * a / (l + r)) of the
    lowest cut. One that lies inside a longer phrase with four fifths of its
    count goes.
    """
    phrases = counts.filter("length >= 2").select("lang", "phrase", "length", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))

    def part(first, size):
        return F.concat_ws(" ", F.slice("w", first, size))

    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1))).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.col("length") - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    score = F.expr("CAST(a AS DECIMAL(20,0)) * 2000000BD div (CAST(l AS DECIMAL(20,0)) + r)").cast("long")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    inner = phrases.filter("length >= 3").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("length") - 1)))
    inner = inner.withColumn("first", F.explode(F.sequence(F.lit(1), F.col("length") - F.col("size") + 1)))
    around = inner.groupBy("lang", part(F.col("first"), F.col("size")).alias("phrase")).agg(F.max("a").alias("most"))
    kept = scored.join(around, ["lang", "phrase"], "left").filter(
        "most IS NULL OR CAST(most AS DECIMAL(20,0)) * 100 < CAST(a AS DECIMAL(20,0)) * 80")
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    # The best of a share first: no task ranks all phrases of a language.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    few = rows.withColumn("share", share).withColumn(
        "at", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).filter(F.col("at") <= top)
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(
        F.col("rank") <= top)
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of ``documents``.

    Null languages are ``und``, null texts empty; repeated rows count each
    time; an empty table has no phrases; other columns are not read.
    """
    docs = table(spark, sf_dir, "documents").select(F.coalesce("lang", F.lit("und")).alias("lang"),
                                                    F.coalesce("text", F.lit("")).alias("text"))
    return collocations(*phrase_counts(docs))


# Plain counting of all phrases, in SQL.
OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM placed CROSS JOIN (VALUES (1), (2), (3), (4)) AS lengths(k) WHERE i + k - 1 <= len(w)),
counts AS (SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, k, unnest(range(1, k)) AS c FROM counts WHERE k >= 2),
scored AS (
  SELECT x.lang, x.phrase, x.a, x.c, l.f AS l, r.f AS r, ((2000000::HUGEINT * x.a) // (l.f + r.f))::BIGINT AS score
  FROM cuts x
  JOIN counts l ON l.lang = x.lang AND l.phrase = array_to_string(x.w[1 : x.c], ' ')
  JOIN counts r ON r.lang = x.lang AND r.phrase = array_to_string(x.w[x.c + 1 : x.k], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
longer AS (SELECT lang, f, k, string_split(phrase, ' ') AS w FROM counts WHERE k >= 3),
spans AS (SELECT lang, f, k, w, s, unnest(range(1, k - s + 2)) AS i FROM longer CROSS JOIN (VALUES (2), (3)) AS sizes(s) WHERE s < k),
around AS (SELECT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, max(f) AS most FROM spans GROUP BY ALL),
kept AS (
  SELECT t.* FROM lowest t LEFT JOIN around o ON o.lang = t.lang AND o.phrase = t.phrase
  WHERE o.most IS NULL OR 100 * o.most < 80 * t.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT x.lang, x.rank, x.phrase, x.a, x.l, x.r, t.n, x.score FROM ranked x JOIN totals t ON t.lang = x.lang WHERE x.rank <= 2000
"""
