"""Labels for text: lexicon scores per row, or a model trained on labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions import vocab as V
from docloom.session import materialize


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.transform(F.array(value), body)[0]


def classify_tokens(words: Column | str, labels: list[str], lexicon: dict[str, dict[str, float]], default: str) -> Column:
    """Exactly one of ``labels`` per non-NULL token array.

    A label scores the summed weight of its lexicon words among the tokens;
    ties go to the earlier label and tokens without any such word get
    ``default``. Scoring stays inside the row, so it costs no shuffle.
    """
    column = F.col(words) if isinstance(words, str) else words
    vocabulary = sorted({word for weights in lexicon.values() for word in weights})
    hits = F.filter(column, lambda t: t.isin(vocabulary))

    def score(found: Column, label: str) -> Column:
        by_weight: dict[float, list[str]] = {}
        for word, weight in lexicon.get(label, {}).items():
            by_weight.setdefault(weight, []).append(word)
        terms = [T.count_of(found, words) * F.lit(float(weight)) for weight, words in sorted(by_weight.items())]
        total = F.lit(0.0)
        for term in terms:
            total = total + term
        return total

    def pick(scores: Column) -> Column:
        best = F.array_max(scores)
        position = F.array_position(scores, best)
        names = F.array(*[F.lit(label) for label in labels])
        return F.when(best > 0, F.element_at(names, position.cast("int"))).otherwise(F.lit(default))

    scores = _bind(hits, lambda found: F.array(*[score(found, label) for label in labels]))
    return F.when(column.isNotNull(), _bind(scores, pick))


def classify(text: Column | str, labels: list[str], lexicon: dict[str, dict[str, float]], default: str) -> Column:
    """``classify_tokens`` of a text (NULL text gives NULL)."""
    return classify_tokens(T.tokens(text), labels, lexicon, default)


def ai_investment_category(words: Column | str, lexicon=None) -> Column:
    """AI category of a token array."""
    return classify_tokens(words, V.AI_CATEGORIES, V.AI_CATEGORY_LEXICON if lexicon is None else lexicon, V.NOT_AI)


def management_sentiment(words: Column | str, lexicon=None) -> Column:
    """Tone of a token array."""
    return classify_tokens(words, V.MANAGEMENT_TONES, V.TONE_LEXICON if lexicon is None else lexicon, V.NEUTRAL_TONE)


def sentiment(text: Column | str, positive=None, negative=None) -> Column:
    """positive / negative / neutral / mixed from polarity word counts."""
    column = F.col(text) if isinstance(text, str) else text
    positive = sorted(V.POSITIVE_WORDS if positive is None else positive)
    negative = sorted(V.NEGATIVE_WORDS if negative is None else negative)
    hits = F.filter(T.tokens(column), lambda t: t.isin(sorted({*positive, *negative})))
    counts = _bind(hits, lambda found: F.array(T.count_of(found, positive), T.count_of(found, negative)))

    def name(pair: Column) -> Column:
        more, less = F.array_max(pair), F.array_min(pair)
        return (
            F.when(more == 0, "neutral")
            .when(less * 2 >= more, "mixed")
            .when(pair[0] > pair[1], "positive")
            .otherwise("negative")
        )

    return F.when(column.isNotNull(), _bind(counts, name))


def train_classifier(labelled: DataFrame, text: str = "text", label: str = "label", features: int = 1 << 12,
                     iterations: int = 10):
    """Fit hashed TF-IDF + logistic regression; returns the fitted pipeline.

    The feature space is fixed by ``features``, so the model's size does not
    grow with the corpus and training aggregates over the partitions. The
    labelled tokens are stored first because every iteration reads them.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF

    rows = labelled.where(F.col(label).isNotNull()).select(
        T.tokens(text).alias("tokens"), F.col(label).cast("double").alias("label")
    )
    rows = materialize(rows, "training")
    model = Pipeline(
        stages=[
            HashingTF(inputCol="tokens", outputCol="tf", numFeatures=features),
            IDF(inputCol="tf", outputCol="features"),
            LogisticRegression(maxIter=iterations, regParam=0.01),
        ]
    ).fit(rows)
    # the summary of the training holds the session, which can't be sent to tasks once a query of it has been observed
    model.stages[-1]._java_obj.setSummary(rows.sparkSession._jvm.scala.Option.empty())
    return model


def save_classifier(model, path: str) -> None:
    """Store a fitted classifier in a folder that all executors share."""
    model.write().overwrite().save(path)


def load_classifier(path: str):
    """A classifier that was stored before: scoring needs no labels and no training."""
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)


def classify_with(df: DataFrame, model, names: list[str], text: str = "text", into: str = "predicted") -> DataFrame:
    """Label every row with a fitted model: ``names[i]`` is the name of label ``i``; a NULL text has none."""
    scored = model.transform(df.withColumn("tokens", T.tokens(F.coalesce(F.col(text), F.lit("")))))
    named = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("prediction") + 1).cast("int"))
    return scored.withColumn(into, F.when(F.col(text).isNotNull(), named)).select(*df.columns, into)


def classify_model(df: DataFrame, labelled: DataFrame, names: list[str], text: str = "text", label: str = "label",
                   into: str = "predicted") -> DataFrame:
    """Same contract as ``classify``, learned: ``names[i]`` is the name of label ``i``."""
    return classify_with(df, train_classifier(labelled, text, label), names, text, into)
