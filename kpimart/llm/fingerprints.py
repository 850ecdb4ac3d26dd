"""Document fingerprints from closed syncmers of words.

Words are runs of characters that are not white space. A k-mer is K words in a
row; its inner substrings are runs of S words. A k-mer is chosen if the one
with the least hash stands first or last in it. Whether it is chosen depends
on its own words only, so two texts that share a long enough passage choose
the same k-mers in it, in the same order: anchors for matching by position.
The fingerprint is the list of the chosen k-mers' 32-bit hashes in text order,
eight hex digits each. Texts with fewer than K words have one anchor, all words.
A text of up to 2 K - S - 2 words may hold no chosen k-mer; then the one of least
hash is its anchor. From one word more on a k-mer is always chosen. Only a text
without words has no anchor.

Likeness is the share of common distinct anchors among all of both. Equal
fingerprints are 1 alike, so are two texts without words.

Edge cases: null texts are empty; equal texts have equal fingerprints, as have
texts that differ in white space only; neighbours in id order are found with
ties broken by the text, null ids last; an empty table gives no rows; only the
two named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpimart.llm.common import cut, let, partitions, table

K, S = 10, 3
SPAN = K - S + 1  # inner substrings of a k-mer; the sliding minimum below is for a power of two
LOW32 = 0xFFFFFFFF


def word_hashes(text: Column) -> Column:
    """A 64-bit hash of each word."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+", -1), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def anchors(text: Column) -> Column:
    """array<long> of the chosen k-mers' 32-bit hashes, in text order."""
    def at(h: Column, i: Column, d: int) -> Column:
        return F.get(h, i + d)

    def least(m: Column, n: Column, d: int) -> Column:
        """Minimum of m at each place and the one ``d`` after it."""
        return F.transform(F.slice(m, 1, n), lambda x, i: F.least(x, at(m, i, d)))

    def chosen(h: Column) -> Column:
        n = F.size(h)
        inner = F.transform(F.slice(h, 1, n - S + 1), lambda x, i: F.xxhash64(x, at(h, i, 1), at(h, i, 2)))

        def of(s: Column) -> Column:
            def mark(i: Column) -> Column:
                return F.xxhash64(at(s, i, 0), at(s, i, 3), at(s, i, 6), at(s, i, 7)).bitwiseAND(LOW32)

            two = least(s, n - S, 1)
            eight = let(two, lambda m2: let(least(m2, n - S - 2, 2), lambda m4: least(m4, n - K + 1, 4)))
            picked = F.transform(eight, lambda m, i: F.when((m == at(s, i, 0)) | (m == at(s, i, SPAN - 1)), mark(i)))
            one = F.array(F.array_min(F.transform(F.slice(s, 1, n - K + 1), lambda _, i: mark(i))))
            return let(F.array_compact(picked), lambda some: F.when(F.size(some) > 0, some).otherwise(one))
        whole = F.when(n == 0, F.array().cast("array<long>")).otherwise(
            F.array(F.aggregate(h, F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x)).bitwiseAND(LOW32)))
        return F.when(n >= K, let(inner, of)).otherwise(whole)
    return let(word_hashes(text), chosen)


def fingerprint(chosen: Column) -> Column:
    return F.array_join(F.transform(chosen, lambda a: F.lpad(F.lower(F.hex(a)), 8, "0")), "")


def likeness(one: Column, other: Column) -> Column:
    """Jaccard likeness of two anchor lists."""
    both = F.size(F.array_intersect(one, other))
    union = F.size(F.array_distinct(one)) + F.size(F.array_distinct(other)) - both
    return F.when(union == 0, 1.0).otherwise(both / union)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (never null), anchors and fingerprint, one row a document."""
    rows = documents(docs, id_col, text_col).withColumn("anchors", anchors(F.col("text")))
    return rows.withColumn("fingerprint", fingerprint(F.col("anchors")))


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def with_next(docs: DataFrame, ranges: int) -> DataFrame:
    """doc_id, text and anchors of ``docs`` (doc_id, text), and as ``next`` text and anchors of the row after it.

    Rows follow one another in descending id order, equal ids in that of a
    hash of the text; the last row's next is the first. They are dealt into
    at most ``ranges`` ranges of ids, where a window looks one row ahead. A
    range's last row meets the head of the next range in a join of as many
    rows as there are ranges.
    """
    found = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10_000)).first()[0] or []
    cuts = sorted(set(found), reverse=True)
    above = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c > F.col("doc_id"))) if cuts else F.lit(0)
    place = F.struct("doc_id", F.xxhash64("text").alias("mark"))
    dealt = docs.withColumns({"range": F.coalesce(F.when(F.col("doc_id").isNotNull(), above), F.lit(len(cuts) + 1)),
                              "place": place})
    after = F.struct("text", "anchors")
    inside = Window.partitionBy("range").orderBy(F.col("place").desc())
    found = dealt.withColumn("anchors", anchors(F.col("text"))).withColumn("next", F.lead(after).over(inside))

    ends = dealt.select("range", "place").groupBy("range").agg(F.max("place").alias("head"), F.min("place").alias("tail"))
    down = Window.orderBy("range")
    first = F.first("head").over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = cut(ends.select("tail", F.coalesce(F.lead("head").over(down), first).alias("head")), "ends")  # a row a range

    def at(end: str) -> DataFrame:
        """The documents at the ends; of equal rows one."""
        keys = F.broadcast(ends.select("tail", F.coalesce(f"{end}.doc_id", F.lit(0)).alias("end_id"),
                                       F.col(f"{end}.doc_id").isNull().alias("end_null"), F.col(f"{end}.mark").alias("end_mark")))
        same = (F.coalesce("doc_id", F.lit(0)) == F.col("end_id")) & (F.col("doc_id").isNull() == F.col("end_null")) & (
            F.xxhash64("text") == F.col("end_mark"))
        return docs.join(keys, same).dropDuplicates(["tail"]).withColumn("anchors", anchors(F.col("text")))

    heads = at("head").select(F.col("tail").alias("of"), after.alias("next"))
    closed = at("tail").join(heads, F.col("tail").eqNullSafe(F.col("of")))
    out = ["doc_id", "text", "anchors", "next"]
    return found.filter(F.col("next").isNotNull()).select(*out).unionByName(closed.select(*out))


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = with_next(documents(table(spark, sf_dir, "documents")), min(2000, 4 * partitions(spark)))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.length("text") - half), F.left("next.text", half))
    rows = pairs.withColumn("edited", edited).withColumn("edited_anchors", anchors(F.col("edited")))
    return rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       fingerprint(F.col("anchors")).alias("fingerprint"),
                       fingerprint(F.col("edited_anchors")).alias("edited_fingerprint"),
                       likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
                       likeness(F.col("anchors"), F.col("next.anchors")).alias("near_next"))
