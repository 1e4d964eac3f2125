"""Tokens, TF-IDF and cosine similarity with a few prototype texts.

Public definition: raw term frequency, idf = ln((1 + n) / (1 + df)) + 1, L2 norm over the
vocabulary. A vocabulary never has more than ``max_features`` terms, which is what bounds the
broadcast side of every join here.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mergelens.functions.arrays import each
from mergelens.functions.stemming import stem_words
from mergelens.functions.words import known_ngrams, ngram_totals

# Training sentences, prototypes and size of the change-type vocabulary.
TRAINING_SENTENCES = (
    "fix bug in authentication module",
    "resolve memory leak issue",
    "patch security vulnerability",
    "correct typo in documentation",
    "hotfix critical error",
    "add new user management feature",
    "implement oauth authentication",
    "create api endpoint for data",
    "introduce new configuration option",
    "enable advanced logging",
    "update readme with examples",
    "add installation guide",
    "improve api documentation",
    "create user manual",
    "write tutorial for beginners",
)
PROTOTYPES = {
    "fix": "fix bug error patch resolve correct",
    "feature": "add new implement create introduce enable",
    "doc": "update readme documentation guide manual tutorial",
}
MAX_FEATURES = 1000
NGRAMS = (1, 2)

_WORD = r"[\p{L}\p{N}_]+"


def english_stop_words() -> list[str]:
    """Spark's public English stop-word list (needs an active session)."""
    return StopWordsRemover.loadDefaultStopWords("english")


def tokens(
    text: Column, stop_words: Sequence[str] = (), stem: bool = False, min_length: int = 1
) -> Column:
    """Lower-cased words without stop words, in order; optionally stemmed."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({_WORD})"))
    if min_length > 1:
        words = F.filter(words, lambda w: F.length(w) >= min_length)
    if stop_words:
        words = F.filter(words, lambda w: ~w.isin(list(stop_words)))
    return stem_words(words) if stem else words


def ngrams(
    words: Column, lengths: tuple[int, int] = NGRAMS, lead: Column | None = None
) -> Column:
    """All n-grams of the given lengths, joined by a space; those with a null word are null.

    ``lead`` holds words that come before: n-grams may start there but not end there.
    """

    def of_length(n: int) -> Column:
        if n == 1:
            return words
        line = words if lead is None else F.concat(_last(lead, n - 1), words)
        count = F.greatest(F.size(line) - (n - 1), F.lit(0))
        joined = F.slice(line, F.lit(1), count)
        for shift in range(1, n):
            joined = F.zip_with(
                joined,
                F.slice(line, F.lit(shift + 1), count),
                lambda left, right: F.concat(left, F.lit(" "), right),
            )
        return joined

    low, high = lengths
    return F.concat(*[of_length(n) for n in range(low, high + 1)])


def _last(words: Column, count: int) -> Column:
    """The last ``count`` words, or all when there are fewer."""
    return F.slice(words, F.greatest(F.size(words) - (count - 1), F.lit(1)), F.lit(count))


def _known_words(words: Column, known: Sequence[str]) -> Column:
    """Words that are part of no known term become null."""
    parts = sorted({word for term in known for word in term.split(" ")})
    return F.transform(words, lambda w: F.when(w.isin(parts), w))


def _known_terms(terms: Column, known: Sequence[str]) -> Column:
    return F.filter(terms, lambda t: t.isNotNull() & t.isin(list(known)))


def with_terms(
    docs: DataFrame,
    text: str = "text",
    stop_words: Sequence[str] = (),
    lengths: tuple[int, int] = NGRAMS,
    stem: bool = False,
    known: Sequence[str] | None = None,
) -> DataFrame:
    """Replace the text by its array of terms (``terms``).

    With ``known`` terms all others are left out; their words are blanked before n-grams are made.
    """
    if not stem and known is not None:
        found = known_ngrams(F.col(text), known, stop_words, 2, lengths)
        return docs.withColumn("_found", found).drop(text).withColumn("terms", F.col("_found.terms")).drop("_found")
    words = docs.withColumn(
        "_words", tokens(F.col(text), stop_words, stem=stem, min_length=2)
    ).drop(text)
    if known is None:
        return words.withColumn("terms", ngrams(F.col("_words"), lengths)).drop("_words")
    blanked = words.withColumn("_words", _known_words(F.col("_words"), known))
    terms = _known_terms(ngrams(F.col("_words"), lengths), known)
    return blanked.withColumn("terms", terms).drop("_words")


def fit_vocabulary(terms: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """``term``, ``df``, ``idf`` of the most frequent terms over rows with a ``terms`` array.

    Every term of a row is sent once with a zero and once per distinct term with a one, so corpus
    and document frequency come out of one pre-aggregated shuffle.
    """
    marks = F.concat(
        F.transform("terms", lambda t: F.struct(t.alias("term"), F.lit(0).alias("first"))),
        F.transform(
            F.array_distinct("terms"),
            lambda t: F.struct(t.alias("term"), F.lit(1).alias("first")),
        ),
    )
    marked = each(terms, [], marks, "_t")
    counted = marked.groupBy(F.col("_t.term").alias("term")).agg(
        F.sum(1 - F.col("_t.first")).alias("tf"), F.sum("_t.first").alias("df")
    )
    return _most_frequent(counted, terms, max_features)


def fit_text_vocabulary(
    docs: DataFrame,
    text: str = "text",
    stop_words: Sequence[str] = (),
    lengths: tuple[int, int] = NGRAMS,
    max_features: int = MAX_FEATURES,
) -> DataFrame:
    """``fit_vocabulary`` of the terms of a text column, which are counted where the texts are cut.

    The result is held as rows (at most ``max_features``), so texts are cut once however often it is used.
    """
    fitted = _most_frequent(ngram_totals(docs, text, stop_words, 2, lengths), docs, max_features)
    return docs.sparkSession.createDataFrame(fitted.collect(), "term string, df bigint, idf double")


def _most_frequent(counted: DataFrame, rows: DataFrame, max_features: int) -> DataFrame:
    """``term``, ``df``, ``idf`` of the terms with the greatest ``tf``."""
    count = rows.agg(F.count(F.lit(1))).scalar()
    return (
        counted.orderBy(F.col("tf").desc(), "term")
        .limit(max_features)
        .select(
            "term",
            "df",
            (F.log((1 + count).cast("double") / (1 + F.col("df"))) + 1).alias("idf"),
        )
    )


def tfidf_weights(terms: DataFrame, vocabulary: DataFrame, key: Sequence[str]) -> DataFrame:
    """L2-normalized weight of every vocabulary term that occurs under a key; null keys have none.

    The norm is a sum beside the rows that it is made of, so texts are not cut again for it.
    """
    named = terms
    for column in key:
        named = named.where(F.col(column).isNotNull())
    # The vocabulary has at most max_features rows.
    counts = (
        each(named, key, F.col("terms"), "term")
        .join(F.broadcast(vocabulary.select("term", "idf")), "term")
        .groupBy(*key, "term", "idf")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    raw = counts.withColumn("_raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(*key)))
    return raw.select(*key, "term", (F.col("_raw") / norm).alias("weight"))


def cosine_to_prototypes(
    terms: DataFrame, vocabulary: DataFrame, prototypes: DataFrame, key: Sequence[str]
) -> DataFrame:
    """One ``similarity_<name>`` column per prototype and row; rows without known terms get 0.

    ``prototypes`` has ``name`` and ``terms``, a handful of rows made from a parameter. Their weights
    and the vocabulary (at most ``max_features`` terms) are constants of a row expression, so texts
    are neither exploded nor shuffled.
    """
    names = [row["name"] for row in prototypes.select("name").collect()]
    idf = {row["term"]: row["idf"] for row in vocabulary.select("term", "idf").collect()}
    weights = {
        (row["name"], row["term"]): row["weight"]
        for row in tfidf_weights(prototypes, vocabulary, ["name"]).collect()
    }
    listed = sorted(idf)
    if not listed:
        return terms.select(*key, *[F.lit(0.0).alias(f"similarity_{name}") for name in names])

    def constants(values: Sequence[str] | Sequence[float]) -> Column:
        return F.array(*map(F.lit, values))

    known = constants(listed)
    places = F.filter(
        F.transform("terms", lambda t: F.array_position(known, t)), lambda place: place > 0
    )
    counted = F.transform(
        F.array_distinct("_places"),
        lambda place: F.struct(
            place.cast("int").alias("place"),
            (
                F.size(F.filter("_places", lambda other: other == place))
                * F.element_at(constants([idf[t] for t in listed]), place.cast("int"))
            ).alias("raw"),
        ),
    )
    rows = terms.select(*key, F.coalesce("terms", F.array().cast("array<string>")).alias("terms"))
    rows = rows.select(*key, places.alias("_places")).select(*key, counted.alias("_raw"))
    norm = F.sqrt(F.aggregate("_raw", F.lit(0.0), lambda acc, r: acc + r["raw"] * r["raw"]))

    def dot(name: str) -> Column:
        own = constants([float(weights.get((name, t), 0.0)) for t in listed])
        return F.aggregate(
            "_raw", F.lit(0.0), lambda acc, r: acc + r["raw"] * F.element_at(own, r["place"])
        )

    return rows.select(*key, norm.alias("_norm"), *[dot(name).alias(name) for name in names]).select(
        *key,
        *[
            F.coalesce(F.col(name) / F.nullif(F.col("_norm"), F.lit(0.0)), F.lit(0.0)).alias(
                f"similarity_{name}"
            )
            for name in names
        ],
    )


class Prototypes:
    """A fitted vocabulary with the prototype texts to compare with.

    Both are small by construction: the vocabulary has at most ``MAX_FEATURES`` terms, and the
    prototypes are a parameter.
    """

    def __init__(
        self,
        spark: SparkSession,
        training: Sequence[str] = TRAINING_SENTENCES,
        prototypes: Mapping[str, str] | None = None,
        stop_words: Sequence[str] | None = None,
    ) -> None:
        self.stop_words = english_stop_words() if stop_words is None else list(stop_words)
        trained = spark.createDataFrame([(t,) for t in training], "text string")
        fixed = list((PROTOTYPES if prototypes is None else prototypes).items())
        named = spark.createDataFrame(fixed, "name string, text string")
        self.vocabulary = fit_vocabulary(with_terms(trained, "text", self.stop_words))
        self.terms = with_terms(named, "text", self.stop_words)
        self.known = [row["term"] for row in self.vocabulary.select("term").collect()]

    def cosine(self, terms: DataFrame, key: Sequence[str]) -> DataFrame:
        return cosine_to_prototypes(terms, self.vocabulary, self.terms, key)


def text_similarity(
    docs: DataFrame,
    key: Sequence[str],
    text: str = "text",
    prototypes: Prototypes | None = None,
    stem: bool = False,
) -> DataFrame:
    """Cosine of every text with every prototype, over the vocabulary of the training texts.

    Only the scored texts are stemmed, never the vocabulary.
    """
    model = prototypes or Prototypes(docs.sparkSession)
    scored = with_terms(
        docs.select(*key, text), text, model.stop_words, stem=stem, known=model.known
    )
    return model.cosine(scored, key)


def _own_terms(text: Column, words: Callable[[Column], Column], model: Prototypes, stem: bool) -> list[Column]:
    """``terms``: the known terms of a text; ``_lead``: its last words, null if part of none."""
    if not stem:
        found = known_ngrams(text, model.known, model.stop_words, 2, NGRAMS)
        return [found["terms"].alias("terms"), found["last"].alias("_lead")]
    blanked = _known_words(words(text), model.known)
    return [
        _known_terms(ngrams(blanked), model.known).alias("terms"),
        _last(blanked, NGRAMS[1] - 1).alias("_lead"),
    ]


def pull_request_similarity(
    prs: DataFrame,
    messages: DataFrame | None,
    key: Sequence[str],
    prototypes: Prototypes | None = None,
    stem: bool = False,
) -> DataFrame:
    """``text_similarity`` of title, body and commit messages as one text.

    ``messages`` has the key and ``commit_messages``. Title and body are reduced to their known
    terms and last words before the messages are joined, so no long text is shuffled.
    """
    model = prototypes or Prototypes(prs.sparkSession)

    def words(text: Column) -> Column:
        return tokens(text, model.stop_words, stem=stem, min_length=2)

    own = (
        prs.select(*key, F.concat_ws(" ", "title", F.coalesce("body", F.lit(""))).alias("_text"))
        .select(*key, *_own_terms(F.col("_text"), words, model, stem))
    )
    if messages is None:
        return model.cosine(own.drop("_lead"), key)
    later = messages.select(
        *key,
        _known_words(words(F.array_join("commit_messages", " ")), model.known).alias("_more"),
    )
    more = _known_terms(ngrams(F.col("_more"), NGRAMS, F.col("_lead")), model.known)
    joined = own.join(later, list(key), "left").withColumn(
        "_more", F.coalesce("_more", F.array().cast("array<string>"))
    )
    return model.cosine(joined.select(*key, F.concat("terms", more).alias("terms")), key)
