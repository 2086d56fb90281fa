"""Quality rules whose cutoffs follow the corpus, per language and source.

Each document gets whole-text counts.  Three ratios of them are sketched per
(lang, source): a sketch counts values by log-linear bucket (exact below 64,
then 32 buckets per power of two, so values are off by 1/32 at most).  Sketches
of groups merge by adding counts, in any order, with one result; groups with
few documents take the merged sketch of their language, or of the corpus.
Cutoffs are fences around the sketched median and are joined to the documents.

Only DataFrame functions run here.  A hot source is pre-aggregated into at most
a few hundred buckets per task; the cutoff table is written first, so Spark
broadcasts it by its measured size or else joins by shuffle.

Defined results: null text counts as empty (no words, fails the base rule);
null lang or source is a group like any other; repeated rows count and are
judged one by one; an empty table gives no rows; extra columns don't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import bound, free_name, stored, text_or_empty

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Groups with fewer documents use the sketch of the next larger group.
MIN_GROUP = 100
#: By ratio: the least distance of a fence from the median, and whether there is a lower fence.
FENCES = {"symbols": (100, False), "dup_lines": (500, False), "word_length": (2000, True)}
#: Otherwise a fence stands this many times the distance from the 10% quantile to the median away.
SPREADS = 6

SPACES = "\t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in the text.

    Window hashes are sorted with their positions as one long each (33 bits of
    the hash, 31 of the position); equal neighbours are candidates, and only these
    are compared by their whole hash.
    """
    low = (1 << 31) - 1
    hashes = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
                         lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))

    def candidates(h: Column) -> Column:
        packed = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))

        def alike(a: Column, b: Column) -> Column:
            return a.bitwiseXOR(b).between(0, low)

        near = bound(packed, lambda s: F.filter(
            s, lambda x, i: alike(F.get(s, i - 1), x) | alike(F.get(s, i + 1), x)))
        at = F.transform(near, lambda x: x.bitwiseAND(F.lit(low)).cast("int"))
        return F.sort_array(F.transform(at, lambda i: F.struct(F.get(h, i).alias("h"), i.alias("i"))))

    def positions(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(3), x - F.coalesce(F.get(p, i - 1), x - 3)))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def total(h: Column) -> Column:
        none = F.size(F.array_distinct(h)) == F.size(h)
        return F.when(none, F.lit(0)).otherwise(bound(bound(candidates(h), positions), covered))

    return bound(hashes, total)


def counts(text: Column, repeats: bool = True) -> Column:
    """Struct of the counts of one text, all as long, and of its lines with a word."""
    flat = text
    for c in SPACES:
        flat = F.replace(flat, F.lit(c), F.lit(" "))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    words = F.array_remove(F.split(flat, " "), "")
    symbols = F.char_length(text) - F.char_length(F.translate(text, "#*$%&|<>", ""))

    def build(w: Column) -> Column:
        return bound(lines, lambda x: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.when(text.rlike("[#*$%&|<>]"), symbols).otherwise(F.lit(0)).cast("long").alias("n_symbols"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            (_repeat_words(w) if repeats else F.lit(0)).cast("long").alias("n_repeat_words"),
            F.size(x).cast("long").alias("n_lines")))

    return bound(words, build)


def _ratios(m: Column) -> dict[str, Column]:
    """Per mille of the words, per mille of the lines, thousandths of a character."""
    def per(a, b):
        return F.floor(m[a] * 1000 / m[b]).cast("long")

    return {"symbols": per("n_symbols", "n_words"), "dup_lines": per("n_dup_lines", "n_lines"),
            "word_length": per("word_chars", "n_words")}


def bucket(x: Column) -> Column:
    """The least value of x's bucket: its six leading binary digits, then zeros."""
    low = F.length(F.bin(x)) - 6
    return F.when(x < 64, x).otherwise(F.call_function("shiftleft", F.call_function("shiftright", x, low), low))


def sketches(docs: DataFrame) -> DataFrame:
    """Mergeable sketches: (lang, source, ratio, value, n) of documents long enough to judge."""
    d = docs.select("lang", "source", counts(text_or_empty(), repeats=False).alias("m"))
    d = d.filter(F.col("m")["n_words"] >= MIN_WORDS)
    pairs = F.array(*[F.struct(F.lit(k).alias("ratio"), bucket(v).alias("value"))
                      for k, v in _ratios(F.col("m")).items()])
    return (d.select("lang", "source", F.inline(pairs))
            .groupBy("lang", "source", "ratio", "value").agg(F.count(F.lit(1)).alias("n")))


def _fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group: its documents, and lower and upper fence by ratio."""
    by = [*keys, "ratio"]
    w = Window.partitionBy(*by)
    s = (sketch.groupBy(*by, "value").agg(F.sum("n").alias("n"))
         .select(*by, "value", F.sum("n").over(w).alias("total"),
                 F.sum("n").over(w.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)).alias("upto")))

    def quantile(percent: int) -> Column:
        return F.min(F.when(F.col("upto") * 100 >= F.col("total") * percent, F.col("value")))

    q = s.groupBy(*by).agg(F.first("total").alias("total"), quantile(10).alias("q10"), quantile(50).alias("q50"))
    out = [F.max("total").alias("total")]
    for ratio, (least, lower) in FENCES.items():
        away = F.greatest(F.lit(least), (F.col("q50") - F.col("q10")) * SPREADS)
        out.append(F.max(F.when(F.col("ratio") == ratio, F.col("q50") + away)).alias(f"{ratio}_most"))
        if lower:
            out.append(F.max(F.when(F.col("ratio") == ratio, F.col("q50") - away)).alias(f"{ratio}_least"))
    return q.groupBy(*keys).agg(*out)


def thresholds(docs: DataFrame) -> DataFrame:
    """Cutoffs by (lang, source), written once; from the language's or the corpus's sketch for small groups."""
    sketch = stored(sketches(docs), "quality_sketch")
    own, lang = _fences(sketch, ["lang", "source"]).alias("o"), _fences(sketch, ["lang"]).alias("l")
    corpus = _fences(sketch, []).first()
    names = [c for c in own.columns if c not in ("lang", "source", "total")]
    joined = own.join(lang, F.col("o.lang").eqNullSafe(F.col("l.lang")), "left")
    picked = [F.when(F.col("o.total") >= MIN_GROUP, F.col(f"o.{n}"))
              .when(F.col("l.total") >= MIN_GROUP, F.col(f"l.{n}"))
              .otherwise(F.lit(corpus[n]).cast("long")).alias(n) for n in names]
    return stored(joined.select("o.lang", "o.source", *picked), "quality_cutoffs")


def judged(docs: DataFrame, cutoffs: DataFrame | None = None) -> tuple[DataFrame, str]:
    """``docs`` with one more column, a struct of the counts, base_failed and kept; and its name."""
    name = free_name(docs, "judged")
    cutoffs = thresholds(docs) if cutoffs is None else cutoffs
    d, c = docs.withColumn(name, counts(text_or_empty())).alias("d"), cutoffs.alias("cut")
    joined = d.join(c, F.col("d.lang").eqNullSafe(F.col("cut.lang"))
                    & F.col("d.source").eqNullSafe(F.col("cut.source")), "left")
    m = F.col(f"d.{name}")
    base_failed = (m["n_words"] < MIN_WORDS) | (m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEAT_PERCENT)
    within = F.lit(True)
    for ratio, value in _ratios(F.when(m["n_words"] > 0, m)).items():
        within &= value <= F.col(f"cut.{ratio}_most")
        if FENCES[ratio][1]:
            within &= value >= F.col(f"cut.{ratio}_least")
    verdict = F.struct(*[m[c].alias(c) for c in COUNTS], base_failed.alias("base_failed"),
                       (~base_failed & F.coalesce(within, F.lit(False))).alias("kept"))
    return joined.select(*[F.col(f"d.`{c}`") for c in docs.columns], verdict.alias(name)), name


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed and kept."""
    d, name = judged(docs)
    return d.select("doc_id", F.col(f"{name}.*"))


def keep(docs: DataFrame) -> DataFrame:
    """The documents that pass, unchanged."""
    d, name = judged(docs)
    return d.filter(F.col(f"{name}.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
