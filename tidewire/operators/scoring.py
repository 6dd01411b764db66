"""Score stage: model choice, sentiment per item, and the result rows it appends."""

import hashlib
import json
import os
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire import schemas as S
from tidewire.functions import sentiment as M
from tidewire.functions import text as X
from tidewire.operators.entities import canonical_name, with_entities

# A model takes a batch of texts and returns one row of probabilities (or logits) per text,
# in the order of its labels. The factory runs once per Python worker and loads the model there.
Predict = Callable[[list[str]], "list[list[float]]"]
ModelFactory = Callable[[], Predict]


@dataclass(frozen=True)
class LexiconModel:
    """Word-list heuristic, evaluated as native expressions."""

    positive: Iterable[str] = M.POSITIVE_WORDS
    negative: Iterable[str] = M.NEGATIVE_WORDS
    name: str = M.LEXICON_MODEL_NAME
    quantized: bool = False


@dataclass(frozen=True)
class BatchModel:
    """Any loaded model; ``batch_size`` texts of like length are predicted at once.

    With ``logits`` the model gives raw scores, and probabilities are made of them natively.
    """

    name: str
    load: ModelFactory
    quantized: bool = False
    labels: tuple[str, ...] = field(default=M.LABELS)
    batch_size: int = 16
    logits: bool = False


Model = LexiconModel | BatchModel


def choose_model(preferred: Callable[[], Model] | None, force_lexicon: bool = False) -> Model:
    """The preferred model if it can be built on the driver, else the lexicon."""
    if force_lexicon or preferred is None:
        return LexiconModel()
    try:
        return preferred()
    except (ImportError, OSError, ValueError):
        return LexiconModel()


def ship(spark: SparkSession, *paths: str) -> None:
    """Send files to all executors; ``shipped`` finds them there by name.

    Names must differ, also from those of files shipped before, unless the path is the same.
    """
    names = [os.path.basename(p) for p in paths]
    if len(set(names)) < len(names):
        raise ValueError(f"files of one name cannot be shipped together: {sorted(names)}")
    for path in paths:
        if not os.path.isfile(path):
            raise FileNotFoundError(path)
        spark.sparkContext.addFile(path)


def shipped(name: str) -> str:
    """Path of a shipped file, on the driver or in a worker."""
    return SparkFiles.get(name)


def linear_model(spark: SparkSession, path: str, name: str | None = None) -> BatchModel:
    """A linear classifier over hashed words, from a NumPy archive that is shipped.

    The archive holds ``weights`` (buckets, labels), ``bias`` (labels) and ``labels``. A text's
    logits are the bias and the mean weight of its words in lower case; a word's bucket is the
    first 16 bits of its MD5 digest, modulo the buckets.
    """
    import numpy as np

    with np.load(path) as archive:
        labels = tuple(str(x) for x in archive["labels"])
    ship(spark, path)
    file = os.path.basename(path)

    def load() -> Predict:
        with np.load(shipped(file)) as archive:
            weights, bias = archive["weights"], archive["bias"]

        def predict(texts: list[str]) -> list[list[float]]:
            rows = []
            for text in texts:
                digests = [hashlib.md5(w.encode(), usedforsecurity=False).digest()
                           for w in text.lower().split()]
                at = [int.from_bytes(d[:2], "big") % len(weights) for d in digests]
                rows.append(bias + weights[at].mean(axis=0) if at else bias)
            return [r.tolist() for r in rows]

        return predict

    return BatchModel(name or file, load, False, labels, logits=True)


def onnx_model(
    spark: SparkSession, model_dir: str, name: str, quantized: bool = True, max_length: int = 256
) -> BatchModel:
    """A sequence classifier exported to ONNX, with its tokenizer and label order beside it.

    Files are checked here, so that a missing model falls back before any job starts, and are
    shipped to the executors. One session per Python worker runs on
    one thread: executors provide the parallelism. The model gives logits.
    """
    import onnxruntime  # noqa: F401
    import tokenizers  # noqa: F401

    path = os.path.join(model_dir, "model_quantized.onnx" if quantized else "model.onnx")
    tokenizer_path = os.path.join(model_dir, "tokenizer.json")
    for required in (path, tokenizer_path):
        if not os.path.exists(required):
            raise FileNotFoundError(required)
    labels = M.LABELS
    config_path = os.path.join(model_dir, "config.json")
    if os.path.exists(config_path):
        with open(config_path) as handle:
            by_id = json.load(handle).get("id2label") or {}
        if by_id:
            labels = tuple(label.lower() for _, label in sorted(by_id.items(), key=lambda p: int(p[0])))
    ship(spark, path, tokenizer_path)
    model_file, tokenizer_file = os.path.basename(path), os.path.basename(tokenizer_path)

    def load() -> Predict:
        import numpy as np
        import onnxruntime as ort
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(shipped(tokenizer_file))
        tokenizer.enable_truncation(max_length)
        tokenizer.enable_padding()
        options = ort.SessionOptions()
        options.intra_op_num_threads = 1
        session = ort.InferenceSession(
            shipped(model_file), options, providers=["CPUExecutionProvider"]
        )
        wanted = {i.name for i in session.get_inputs()}

        def predict(texts: list[str]) -> list[list[float]]:
            encoded = tokenizer.encode_batch(texts)
            inputs = {
                "input_ids": np.array([e.ids for e in encoded], dtype=np.int64),
                "attention_mask": np.array([e.attention_mask for e in encoded], dtype=np.int64),
                "token_type_ids": np.array([e.type_ids for e in encoded], dtype=np.int64),
            }
            return session.run(None, {k: v for k, v in inputs.items() if k in wanted})[0].tolist()

        return predict

    return BatchModel(name, load, quantized, labels, logits=True)


def _batch_probs(model: BatchModel):
    load, size = model.load, model.batch_size

    @F.pandas_udf("array<double>")
    def probs(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load()

        def several(some: list[str]) -> list:
            """Predictions; a text that fails alone has none, and takes no other along."""
            try:
                return predict(some)
            except MemoryError:
                raise
            except Exception:
                return [None] if len(some) == 1 else [p for t in some for p in several([t])]

        for texts in batches:
            present = texts.dropna()
            by_length = present.loc[present.str.len().sort_values(kind="stable").index]
            rows: list = []
            for at in range(0, len(by_length), size):
                rows += several(by_length.iloc[at: at + size].tolist())
            yield pd.Series(rows, index=by_length.index, dtype=object).reindex(texts.index)

    return probs


def add_sentiment(items: DataFrame, model: Model, text: Column) -> DataFrame:
    """Items plus ``sentiment``; NULL where the model failed on the text."""
    if isinstance(model, LexiconModel):
        counted = items.withColumn("_tokens", M.lexicon_tokens(text)).withColumns(
            {
                "_pos": M.count_words(F.col("_tokens"), model.positive),
                "_neg": M.count_words(F.col("_tokens"), model.negative),
            }
        )
        scored = counted.withColumn(
            "sentiment", M.lexicon_sentiment(F.col("_pos"), F.col("_neg"))
        )
        return scored.drop("_tokens", "_pos", "_neg")
    probs = items.withColumn("_probs", _batch_probs(model)(text))
    if model.logits:
        probs = probs.withColumn("_probs", M.softmax(F.col("_probs")))
    value = M.label_from_probs(F.col("_probs"), model.labels)
    return probs.withColumn("sentiment", F.when(F.col("_probs").isNotNull(), value)).drop("_probs")


def score(
    processed: DataFrame,
    inferred_at: Column,
    model: Model | None = None,
    gazetteer: Mapping[str, str] | DataFrame | None = None,
) -> DataFrame:
    """Processed items plus ``sentiment``, ``entities``, model columns and ``inferred_at``.

    Items the model could not score have a NULL ``sentiment``.
    """
    model = model or LexiconModel()
    text = X.model_text(F.col("title"), F.col("body"))
    scored = add_sentiment(processed, model, text)
    return with_entities(scored, gazetteer).withColumns(
        {
            "model_name": F.lit(model.name),
            "quantized": F.lit(model.quantized),
            "inferred_at": inferred_at,
        }
    )


def sentiment_results(scored: DataFrame, *extra: str) -> DataFrame:
    """One result row per scored item."""
    return scored.filter("sentiment is not null").select(
        F.col("id").alias("item_id"),
        "content_hash",
        "source",
        F.col("sentiment.label").alias("sentiment_label"),
        F.col("sentiment.score").alias("sentiment_score"),
        *[F.coalesce(f"sentiment.prob_{n}", F.lit(0.0)).alias(f"prob_{n}") for n in M.LABELS],
        "model_name",
        "quantized",
        "published_at",
        "inferred_at",
        *extra,
    )


def unscorable(scored: DataFrame) -> DataFrame:
    """``item_id, error`` of the items that the model could not score; no table holds them."""
    return scored.filter("sentiment is null").select(
        F.col("id").alias("item_id"), F.lit("model error").alias("error")
    )


def entity_sentiments(scored: DataFrame, *extra: str) -> DataFrame:
    """One row per item and entity: the time series signals are computed from."""
    return _exploded(scored, F.col("entities"), *extra)


def entity_series(scored: DataFrame, *extra: str) -> DataFrame:
    """As ``entity_sentiments``, but an item counts once per name.

    Signals group by name only, so a ticker spelled like a company must not add a second
    sample with the same time.
    """
    names = F.transform("entities", lambda e: canonical_name(e["text"], e["type"]))
    once = F.filter(
        "entities",
        lambda e, i: F.array_position(names, canonical_name(e["text"], e["type"])) == i + 1,
    )
    return _exploded(scored, once, *extra)


def _exploded(scored: DataFrame, entities: Column, *extra: str) -> DataFrame:
    return (
        scored.filter("sentiment is not null")
        # The outer form keeps the optimizer from matching the text again in a filter.
        .withColumn("_e", F.explode_outer(entities))
        .filter("_e is not null")
        .select(
            F.col("id").alias("item_id"),
            canonical_name(F.col("_e.text"), F.col("_e.type")).alias("entity"),
            F.col("_e.type").alias("entity_type"),
            F.col("sentiment.score").alias("sentiment_score"),
            "published_at",
            "inferred_at",
            *extra,
        )
    )


def result_json(scored: DataFrame) -> DataFrame:
    """One JSON line per scored item, scores rounded to six places."""

    def iso(ts: str) -> Column:
        return F.regexp_replace(X.format_rfc3339(F.col(ts)), "Z$", "+00:00")

    probs = [F.round(f"sentiment.prob_{n}", 6).alias(n) for n in M.LABELS]
    return scored.filter("sentiment is not null").select(
        F.to_json(
            F.struct(
                "id", "content_hash", "source",
                F.col("sentiment.label").alias("sentiment_label"),
                F.round("sentiment.score", 6).alias("sentiment_score"),
                F.struct(*probs).alias("sentiment_probs"),
                "entities", "model_name", "quantized",
                iso("published_at").alias("published_at"),
                iso("inferred_at").alias("inferred_at"),
            )
        ).alias("value")
    )


RESULT_COLUMNS = [f.name for f in S.SCORED]
ENTITY_COLUMNS = [f.name for f in S.ENTITY]
