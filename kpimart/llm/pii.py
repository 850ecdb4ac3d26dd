"""Personal data by candidate gradient boosting.

High-recall generators propose spans that may overlap. Those that pass their
kind's check are personal data: the base. The others are judged by boosted
trees on features of their format and of the characters around them. The trees
learn weakly: candidates that pass a check, or that a telling word precedes,
against the rest; neither the checks nor those words are features. A threshold
for each kind is calibrated on all candidates, each scored by trees from the
other half, so that ``precision`` of what is added holds; a kind that cannot
reach it adds nothing. Added spans never overlap the base, and of added ones that overlap
the likeliest stays.

Candidates are counted by their features over all documents. The trees are
fitted on the driver from at most ``bound`` distinct feature rows: a sample by
hash, in which frequent rows come sooner, dealt round by kind. The thresholds
come from all feature rows, scored, sorted and summed in Spark.

Positions are code points, ends exclusive. Edge cases: null and empty texts
have no spans; without candidates nothing is added; rows with equal ids are
searched each; further columns are kept under their names.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpimart.llm.common import cut, fresh, let, partitions, table

# Java patterns. A run of characters is tried from its start only, or from the
# end of the match before it (\G), and loops give nothing back: the matches are
# those of the plain patterns, without their cost on long runs.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # whole runs of digits with single separators, of 16 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "handle": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++",
    "number": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{2,3}[.-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16,}+",
}
KINDS = list(PATTERNS)
BASE = KINDS[:4]
MAYBE = r"[0-9@]|\(at\)|\[at\]"  # every candidate has one of these
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
TELLING = r"(?i)(?:token|secret|password|passwd|key|auth|mail|contact|phone|tel|call|ssn)\W{0,5}$"
AROUND = 16
FEATURES = ("kind", "chars", "digits", "letters", "upper", "hex", "marks", "changes", "dots", "before", "after", "assigned")
TOP = 63  # the largest value of a feature
PLACES = 9  # decimals to which scores are told apart
SLACK = 1e-9  # below a threshold: more than the rounding takes off


def luhn(digits: Column) -> Column:
    def worth(c: Column, i: Column) -> Column:
        v = c.cast("int") * (1 + i % 2)
        return F.when(v > 9, v - 9).otherwise(v)
    values = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), worth)
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def passes(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return found.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(False)


def group_of(c: Column) -> Column:
    """Kind of a neighbouring character: none, blank, quote, letter or digit, other."""
    return (F.when(c == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike("^[\"'`]$"), 2)
            .when(c.rlike(r"^[\p{L}\p{N}]$"), 3).otherwise(4))


def features(kind: int, found: Column, before: Column, after: Column) -> Column:
    n = {"chars": F.length(found), "digits": F.regexp_count(found, F.lit("[0-9]")),
         "letters": F.regexp_count(found, F.lit("[A-Za-z]")), "upper": F.regexp_count(found, F.lit("[A-Z]")),
         "hex": F.regexp_count(found, F.lit("[A-Fa-f]")), "marks": F.regexp_count(found, F.lit("[^A-Za-z0-9]")),
         "changes": F.regexp_count(found, F.lit("[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])")),
         "dots": F.regexp_count(found, F.lit(r"\.")), "before": group_of(F.right(before, F.lit(1))),
         "after": group_of(F.left(after, F.lit(1))), "assigned": before.rlike("[=:]\\s*[\"']?$").cast("int")}
    return F.array(F.lit(kind), *[F.least(n[f].cast("int"), F.lit(TOP)) for f in FEATURES[1:]])


def found_by(text: Column, kind: str) -> Column:
    """Candidates of a kind, left to right: kind, start, end, valid, label, features."""
    pattern = F.lit(PATTERNS[kind])
    number = KINDS.index(kind)

    def place(done: Column, one: Column) -> Column:
        begin = done["at"] + F.length(one["gap"])
        end = begin + F.length(one["found"])
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(F.struct(
            begin.alias("start"), end.alias("end"), one["found"].alias("found")))).alias("spans"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,found:string>>").alias("spans"))
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    pairs = let(matches, lambda m: F.zip_with(m, F.slice(F.split(text, PATTERNS[kind], -1), F.lit(1), F.size(m)),
                                              lambda a, b: F.struct(a.alias("found"), b.alias("gap"))))
    spans = F.aggregate(pairs, none, place)["spans"]

    def judged(s: Column) -> Column:
        before = F.substr(text, F.greatest(s["start"] - AROUND, F.lit(0)) + 1, F.least(s["start"], F.lit(AROUND)))
        after = F.substr(text, s["end"] + 1, F.lit(1))
        valid = passes(kind, s["found"])
        return F.struct(F.lit(number).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), valid.alias("valid"),
                        (valid | before.rlike(TELLING)).cast("int").alias("label"),
                        features(number, s["found"], before, after).alias("features"))
    return F.transform(spans, judged)


SPANS = "array<struct<kind:int,start:int,end:int,valid:boolean,label:int,features:array<int>>>"


def candidates(text: Column) -> Column:
    """All candidates by kind, then start."""
    every = F.concat(*[found_by(text, k) for k in KINDS]).cast(SPANS)
    return F.when(text.rlike(MAYBE), every).otherwise(F.array().cast(SPANS))


@dataclass
class Model:
    """Sum of ``start`` and trees is the log-odds; a tree is nested (feature, limit, low, high) or a number."""

    start: float
    trees: list
    limits: dict[int, float]  # kind to the least log-odds that is added

    def score(self, f: Column) -> Column:
        def walk(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(tree)
            at, limit, low, high = tree
            return F.when(F.get(f, F.lit(at)) <= limit, walk(low)).otherwise(walk(high))
        total = F.lit(self.start)
        for tree in self.trees:
            total = total + walk(tree)
        return total


def grow(x: np.ndarray, n: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int, rate: float):
    """One regression tree by histograms of gradients."""
    g, h = grad.sum(), hess.sum()
    leaf = float(rate * g / (h + 1.0))
    if depth == 0 or len(x) < 2:
        return leaf
    best = (1e-6, None, None)
    for f in range(x.shape[1]):
        gl = np.cumsum(np.bincount(x[:, f], grad, TOP + 1))[:-1]
        hl = np.cumsum(np.bincount(x[:, f], hess, TOP + 1))[:-1]
        gain = gl ** 2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g ** 2 / (h + 1)
        at = int(np.argmax(gain))
        if gain[at] > best[0]:
            best = (float(gain[at]), f, at)
    _, f, at = best
    if f is None:
        return leaf
    low = x[:, f] <= at
    return (f, at, *[grow(x[k], n[k], grad[k], hess[k], depth - 1, rate) for k in (low, ~low)])


def predict(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, at, low, high = tree
    return np.where(x[:, f] <= at, predict(low, x), predict(high, x))


def boost(x: np.ndarray, y: np.ndarray, n: np.ndarray, trees: int, depth: int, rate: float) -> tuple[float, list]:
    """Gradient boosting of the logistic loss over distinct rows with counts."""
    share = min(max(float(n @ y / n.sum()), 1e-3), 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    z, grown = np.full(len(y), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        tree = grow(x, n, n * (y - p), n * p * (1 - p), depth, rate)
        grown.append(tree)
        z = z + predict(tree, x)
    return start, grown


def fold_of(features: list[int]) -> int:
    """The half a feature row is in; ``fold`` is the same as a column."""
    return zlib.crc32(",".join(map(str, features)).encode()) % 2


def fold(features: Column) -> Column:
    return F.crc32(F.array_join(features.cast("array<string>"), ",").cast("binary")) % 2


def learn(rows: list[tuple[list[int], int, int]], trees: int, depth: int, rate: float) -> tuple[Model, list[Model]]:
    """The model of all ``rows``, without limits, and for each half the model of the other one."""
    rows = sorted(rows)
    x = np.array([r[0] for r in rows])
    y, n = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows], float)
    half = np.array([fold_of(r[0]) for r in rows])

    def model(k: np.ndarray) -> Model:
        return Model(*boost(x[k], y[k], n[k], trees, depth, rate), {}) if k.any() else Model(0.0, [], {})
    return model(half >= 0), [model(half != k) for k in (0, 1)]


def fit(rows: list[tuple[list[int], int, int]], precision: float = 0.95, trees: int = 20, depth: int = 3,
        rate: float = 0.3, least: int = 5) -> Model:
    """``rows``: features, label and how often. ``least`` candidates have to back a threshold."""
    if not rows:
        return Model(0.0, [], {})
    model, halves = learn(rows, trees, depth, rate)
    x = np.array([r[0] for r in rows])
    y, n = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows], float)
    half, z = np.array([fold_of(r[0]) for r in rows]), np.zeros(len(rows))
    for k, other in enumerate(halves):
        z[half == k] = other.start + sum(predict(tree, x[half == k]) for tree in other.trees)
    z = z.round(PLACES)
    for kind in range(len(KINDS)):
        own = np.flatnonzero(x[:, 0] == kind)
        own = own[np.argsort(-z[own], kind="stable")]
        count, right = np.cumsum(n[own]), np.cumsum((n * y)[own])
        # only where the score drops may a threshold lie
        ends = np.append(z[own][1:] < z[own][:-1], True) if len(own) else np.empty(0, bool)
        good = np.flatnonzero(ends & (count >= least) & (right >= precision * count))
        if len(good):
            model.limits[kind] = float(z[own][good[-1]]) - SLACK
    return model


def limits_of(scored: DataFrame, precision: float, least: int) -> dict[int, float]:
    """Kind to the least score that is added, from ``scored``: kind, score, n and hits, any number of rows.

    Rows of equal kind and score are one. Sums run down the scores of a kind in
    ranges of scores; only the sums of the ranges are added up in one task.
    """
    sums = scored.groupBy("kind", "score").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    order = [F.col("kind"), F.col("score").desc()]
    dealt = sums.repartitionByRange(partitions(scored.sparkSession), *order).withColumn("part", F.spark_partition_id())
    dealt = cut(dealt, "scores")
    above = Window.partitionBy("kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = dealt.groupBy("kind", "part").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).select(
        "kind", "part", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"),
        F.coalesce(F.sum("hits").over(above), F.lit(0)).alias("hits_above"))
    down = Window.partitionBy("kind", "part").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    run = dealt.withColumns({"count": F.sum("n").over(down), "right": F.sum("hits").over(down)}).join(
        F.broadcast(firsts), ["kind", "part"])
    count, right = F.col("count") + F.col("n_above"), F.col("right") + F.col("hits_above")
    good = run.filter((count >= least) & (right >= F.lit(float(precision)) * count))
    return {r["kind"]: r["score"] - SLACK for r in good.groupBy("kind").agg(F.min("score").alias("score")).collect()}


def fit_pii(docs: DataFrame, text_col: str = "text", bound: int = 20_000, precision: float = 0.95, trees: int = 20,
            depth: int = 3, rate: float = 0.3, least: int = 5) -> Model:
    """The trees from at most ``bound`` distinct feature rows, the thresholds from all."""
    each = docs.select(F.explode(candidates(F.col(text_col))).alias("c")).groupBy("c.features").agg(
        F.count("*").alias("n"), F.sum("c.label").alias("hits"))
    each = cut(each.withColumn("kind", F.get("features", F.lit(0))), "features")
    # An exponential draw by n: the chance of a row to come first is its share of the candidates.
    draw = -F.log((F.pmod(F.xxhash64(F.lit(1), "features"), F.lit(1 << 52)) + 1) / F.lit(float(1 << 52))) / F.col("n")
    turn = Window.partitionBy("kind").orderBy("draw", "features")
    sample = each.withColumn("draw", draw).withColumn("turn", F.row_number().over(turn)).filter(F.col("turn") <= bound)
    rows = sample.orderBy("turn", "kind").limit(bound).select("features", "n", "hits").collect()
    if not rows:
        return Model(0.0, [], {})
    parts = [(list(r.features), label, k) for r in rows for label, k in ((0, r.n - r.hits), (1, r.hits)) if k]
    model, halves = learn(parts, trees, depth, rate)
    score = F.when(fold(F.col("features")) == 0, halves[0].score(F.col("features"))).otherwise(halves[1].score(F.col("features")))
    model.limits = limits_of(each.select("kind", F.round(score, PLACES).alias("score"), "n", "hits"), precision, least)
    return model


def spans(text: Column, model: Model) -> Column:
    """The base and the added spans, by kind, then start."""
    shape = "array<struct<kind:int,start:int,end:int,valid:boolean,score:double>>"

    def scored(c: Column) -> Column:
        return F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["valid"].alias("valid"),
                        model.score(c["features"]).alias("score"))

    def enough(c: Column) -> Column:
        out = F.lit(False)
        for kind, least in model.limits.items():
            out = out | ((c["kind"] == kind) & (c["score"] >= least))
        return out

    def meets(a: Column, b: Column) -> Column:
        return (a["start"] < b["end"]) & (b["start"] < a["end"])

    def chosen(all_: Column) -> Column:
        base = F.filter(all_, lambda c: c["valid"])
        more = F.filter(all_, lambda c: ~c["valid"] & enough(c) & ~F.exists(base, lambda b: meets(c, b)))

        def best(some: Column) -> Column:
            def beaten(a: Column, b: Column) -> Column:
                key = lambda s: F.struct(-s["score"], s["start"], s["kind"])
                return meets(a, b) & (key(b) < key(a))
            return F.concat(base, F.filter(some, lambda a: ~F.exists(some, lambda b: beaten(a, b))))
        return let(more, best)

    return F.array_sort(let(F.transform(candidates(text), scored).cast(shape), chosen))


def joined(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, found: Column) -> Column:
    """The text with each stretch of spans replaced by its first span's kind in angle brackets."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    order = F.array_sort(F.transform(found, lambda s: F.struct(s["start"], s["end"], s["kind"])))

    def put(done: Column, s: Column) -> Column:
        apart = s["start"] >= done["at"]
        more = F.concat(done["out"], F.substr(text, done["at"] + 1, s["start"] - done["at"]), F.get(names, s["kind"]))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.when(apart, more).otherwise(done["out"]).alias("out"))

    done = F.aggregate(order, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), put)
    return F.when(F.size(found) > 0, let(done, lambda d: F.concat(d["out"], F.substr(text, d["at"] + 1)))).otherwise(text)


def find_pii(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` and a column of spans, named ``pii`` or, if taken, ``pii_1`` and so on."""
    return docs.withColumn(fresh(docs, "pii"), spans(F.coalesce(F.col(text_col), F.lit("")), model))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs, fit_pii(docs))
    base = F.filter("pii", lambda s: s["valid"])

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["valid"] & (s["kind"] == KINDS.index(kind)))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("pii")).alias("spans"))
