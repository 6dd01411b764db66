"""Sentiment as column expressions: lexicon scoring and softmax over logits."""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label order (it breaks ties), model name, token pattern, finance lexicon.
LABELS = ("positive", "negative", "neutral")
LEXICON_MODEL_NAME = "heuristic-lexicon-v1"
TOKEN_PATTERN = "[a-z']+"
POSITIVE_WORDS = (
    "beat", "beats", "beating", "rose", "rise", "rises", "jumped", "jump", "jumps",
    "record", "surge", "surged", "gain", "gains", "gained", "strong", "stronger",
    "profit", "profits", "upgrade", "upgraded", "raise", "raised", "growth", "grew",
    "outperform", "bullish", "rally", "rallied", "tops", "topped", "expands",
)
NEGATIVE_WORDS = (
    "miss", "misses", "missed", "fell", "fall", "falls", "slide", "slides", "slid",
    "cut", "cuts", "cutting", "recall", "recalls", "weak", "weaker", "loss", "losses",
    "downgrade", "downgraded", "warn", "warns", "warned", "drop", "drops", "dropped",
    "decline", "declined", "bearish", "plunge", "plunged", "lawsuit", "probe",
)
LABEL_SIGN = {"positive": 1.0, "neutral": 0.0, "negative": -1.0}


def lexicon_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN_PATTERN})"), 1)


def count_words(tokens: Column, words: Iterable[str]) -> Column:
    vocabulary = list(words)
    return F.size(F.filter(tokens, lambda t: t.isin(vocabulary)))


def sentiment(label: Column, score: Column, probs: dict[str, Column]) -> Column:
    """One sentiment value: label, signed score and one probability per label."""
    return F.struct(
        label.alias("label"),
        score.alias("score"),
        *[probs[name].alias(f"prob_{name}") for name in LABELS],
    )


def lexicon_sentiment(positive: Column, negative: Column) -> Column:
    """Sentiment from the counts of positive and negative words.

    The double arithmetic is evaluated in exactly this order: labels of mixed texts hang
    on the last bit, so the formula must not be simplified.
    """
    total = (positive + negative).cast("double")
    confidence = total / (total + F.lit(2.0))
    p_pos = F.when(total > 0, positive / total * confidence).otherwise(F.lit(0.0))
    p_neg = F.when(total > 0, negative / total * confidence).otherwise(F.lit(0.0))
    p_neu = F.lit(1.0) - (p_pos + p_neg)
    label = (
        F.when((p_pos >= p_neg) & (p_pos >= p_neu), F.lit("positive"))
        .when(p_neg >= p_neu, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )
    return sentiment(
        label, p_pos - p_neg, {"positive": p_pos, "negative": p_neg, "neutral": p_neu}
    )


def softmax(logits: Column) -> Column:
    """Numerically stable softmax over an array of doubles."""
    exps = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    total = F.aggregate(exps, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(exps, lambda e: e / total)


def label_from_probs(probs: Column, labels: Sequence[str] = LABELS) -> Column:
    """Sentiment from model probabilities given in the model's own label order.

    The first of equal maxima wins; a label the model does not know has probability 0.
    """
    by_label = {
        name: probs[labels.index(name)] if name in labels else F.lit(0.0) for name in LABELS
    }
    names = F.array(*[F.lit(name) for name in labels])
    best = F.element_at(names, F.array_position(probs, F.array_max(probs)).cast("int"))
    return sentiment(best, by_label["positive"] - by_label["negative"], by_label)


def label_sign(label: Column) -> Column:
    pairs = [F.lit(v) for item in LABEL_SIGN.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), label)
