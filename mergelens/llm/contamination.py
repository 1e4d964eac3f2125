"""Benchmark passages in documents: a prefix-filtered set join, with DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mergelens.session import cut_lineage

#: Signs between words (fixed values): ASCII other than digits and letters.
SPLIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a shingle.
SHINGLE = 3
#: Benchmark shingles up to which they are broadcast (about 20 MB); beyond, the join shuffles.
BROADCAST_SHINGLES = 500_000


def words_of(text: Column) -> Column:
    """Runs of digits, letters and signs beyond ASCII, with A-Z lower-cased; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), SPLIT)
    low = F.transform(
        parts,
        lambda w: F.when(F.octet_length(w) == F.char_length(w), F.lower(w)).otherwise(
            F.translate(w, _UPPER, _LOWER)
        ),
    )
    return F.filter(low, lambda w: w != "")


def with_shingles(df: DataFrame, words: str, size: int, out: str) -> DataFrame:
    """``df`` with the 64-bit hash of every run of ``size`` words of an array column, in order."""
    ones = f"_{out}"
    df = df.withColumn(ones, F.transform(words, lambda w: F.xxhash64(w)))
    runs = F.col(ones)
    for offset in range(1, size):
        later = F.slice(ones, offset + 1, F.greatest(F.size(ones), F.lit(1)))
        runs = F.zip_with(runs, later, lambda a, b: F.xxhash64(a, b))
    whole = F.slice(runs, 1, F.greatest(F.size(ones) - (size - 1), F.lit(0)))
    return df.withColumn(out, whole).drop(ones)


def item_shingles(benchmark: DataFrame, window: int) -> DataFrame:
    """Every shingle of the items: item, place, size, hash, words, and the item's window and count.

    The window of an item is ``window`` words, or all words of a shorter one, whose shingles may be
    shorter too. Items without words or id have none; repeated items have one set.
    """
    items = (
        benchmark.where(F.col("item_id").isNotNull())
        .select(F.col("item_id").alias("item"), words_of(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
        .dropDuplicates(["item", "words"])
        .withColumn("part", F.xxhash64("words"))
        .withColumn("window", F.least(F.size("words"), F.lit(window)))
        .withColumn("size", F.least(F.size("words"), F.lit(SHINGLE)))
    )
    by_size = [
        with_shingles(items.where(F.col("size") == size), "words", size, "hashes").select(
            "item", "part", "window", "size", "words",
            F.posexplode("hashes").alias("place", "hash"),
        )
        for size in range(1, SHINGLE + 1)
    ]
    return reduce(DataFrame.unionByName, by_size).select(
        "item", "part", "window", "size", "place", "hash",
        F.array_join(F.expr("slice(words, place + 1, size)"), " ").alias("run"),
    )


def shingle_hits(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Places of documents where a benchmark shingle stands: doc_id, at, size, hash, run.

    All words are hashed; only shingles of ``wanted`` go further, with their words. Sizes other
    than the usual one are looked up only if the benchmark has such items. Arrays are exploded in
    the outer form: for the inner one Spark tests their size, and so computes them twice.
    """
    known = cut_lineage(wanted.select("size", "hash").distinct())
    counted = {r["size"]: r["n"] for r in known.groupBy("size").agg(F.count("*").alias("n")).collect()}
    small = sum(counted.values()) <= BROADCAST_SHINGLES
    spoken = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id", words_of(F.col("text")).alias("words")
    )
    found = []
    for size in sorted(counted) or [SHINGLE]:
        own = known.where(F.col("size") == size).select("hash")
        places = with_shingles(spoken, "words", size, "hashes").select(
            "doc_id", "words", F.posexplode_outer("hashes").alias("at", "hash")
        )
        hits = places.where(F.col("at").isNotNull()).join(F.broadcast(own) if small else own, "hash", "left_semi")
        found.append(
            hits.select(
                "doc_id", "at", F.lit(size).alias("size"), "hash",
                F.array_join(F.slice("words", F.col("at") + 1, size), " ").alias("run"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """Stretches of documents that repeat an item: doc_id, item, first, last (word places).

    1. Shingles of the benchmark found in the documents are written with their counts.
    2. In every item window the rarest shingle, by those counts, is the prefix token: a window of
       k shingles that occurs whole has all k, so a prefix of one is enough.
    3. Prefix tokens found in a document give (document, item, shift); positions bound the window
       to one place, and its length to the item's.
    4. All hits on such a shift are put in order; a run of as many neighbours as a window has
       shingles is an occurrence, since their words are compared, not hashes.
    """
    wanted = cut_lineage(item_shingles(benchmark, window))
    hits = cut_lineage(shingle_hits(docs, wanted))
    counts = hits.groupBy("size", "hash").agg(F.count("*").alias("seen"))
    need = F.col("window") - F.col("size") + 1
    ranked = wanted.join(counts, ["size", "hash"], "left").withColumn(
        "rarity", F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "place")
    )
    ahead = Window.partitionBy("item", "part").orderBy("place").rowsBetween(0, window - SHINGLE)
    windows = (
        ranked.withColumn("need", need)
        .withColumn("last", F.max("place").over(Window.partitionBy("item", "part")))
        .withColumn("ahead", F.collect_list("rarity").over(ahead))
        .where(F.col("place") + F.col("need") - 1 <= F.col("last"))
        .withColumn("least", F.array_min(F.slice("ahead", 1, F.col("need"))))
        .where(F.col("least.seen") > 0)
    )
    prefix = windows.select("item", "part", F.col("least.place").alias("place")).distinct()
    tokens = wanted.join(prefix, ["item", "part", "place"], "left_semi")
    same = ["size", "hash", "run"]
    shift = (F.col("at") - F.col("place")).alias("shift")
    candidates = hits.join(tokens, same).select("doc_id", "item", "part", shift).distinct()
    aligned = (
        hits.join(wanted, same)
        .select("doc_id", "item", "part", shift, "place", "window", "size")
        .join(candidates, ["doc_id", "item", "part", "shift"], "left_semi")
        .distinct()
    )
    line = Window.partitionBy("doc_id", "item", "part", "shift").orderBy("place")
    return (
        aligned.withColumn("run", F.col("place") - F.row_number().over(line))
        .groupBy("doc_id", "item", "part", "shift", "run", "window", "size")
        .agg(F.min("place").alias("from"), F.max("place").alias("to"))
        .where(F.col("to") - F.col("from") + F.col("size") >= F.col("window"))
        .select(
            "doc_id",
            "item",
            (F.col("from") + F.col("shift")).alias("first"),
            (F.col("to") + F.col("size") - 1 + F.col("shift")).alias("last"),
        )
    )


def contaminated_ids(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """The distinct ids of the documents that ``contamination`` calls contaminated."""
    judged = contamination(docs, benchmark, window)
    return judged.where("contaminated").select("doc_id").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document row.

    A word is hit if an occurrence of a window covers it; a document is contaminated if at least a
    twentieth of its words, and one, are hit. Null and empty texts have no words and no hits. Rows
    of one doc_id share their hits: of rows with different texts, those of all. Rows without
    doc_id are not searched. Empty tables give no hits. Other columns are not read.
    """
    found = occurrences(docs, benchmark, window)
    line = Window.partitionBy("doc_id").orderBy("first", "last")
    reach = F.max("last").over(line.rowsBetween(Window.unboundedPreceding, -1))
    covered = F.greatest(
        F.lit(0), F.col("last") - F.greatest(F.col("first") - 1, F.coalesce(reach, F.lit(-1)))
    )
    hit = (
        found.withColumn("covered", covered)
        .groupBy("doc_id")
        .agg(
            F.sum("covered").alias("n_hit"),
            F.collect_set(F.col("item").cast("string")).alias("items"),
        )
    )
    parts = F.split(F.coalesce(F.col("text"), F.lit("")), SPLIT)
    facts = docs.select(
        "doc_id", F.size(F.filter(parts, lambda w: w != "")).cast("long").alias("n_words")
    )
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return facts.join(hit, "doc_id", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )
