"""Language of texts: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained by follow-the-regularised-leader with elastic-net penalties on a bounded sample,
then calibrated by one temperature. Inside tasks whole batches of text are scored as arrays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacegrid.llm.rule_quality import HELD_FOLD, fold_of
from pacegrid.llm.stages import remove, staged, text_slices

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SAMPLE_PER_LANGUAGE = 400
MOST_LANGUAGES = 256
EPOCHS = 4
ALPHA, BETA, LASSO, RIDGE = 0.5, 1.0, 0.05, 0.01
SCALE = 50.0
CALIBRATED = 5  # one row in so many sets the temperature
UNKNOWN = "und"
SLICE_CHARS = 1_000_000
# Also numerals such as a superscript two or a Roman eight, which `has_letter` sorts out.
LETTER_OR_NUMERAL = re.compile(r"[^\W\d_]")

_COUNTS = "lang string, buckets binary, counts binary"
_SEEN = "bucket int, documents long"
_FOUND = "doc_id long, held_out boolean, lang_pred string, score double"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def has_letter(text: str) -> bool:
    return any(found.group().isalpha() for found in LETTER_OR_NUMERAL.finditer(text))


def folded(text: str) -> np.ndarray:
    """Code points of the lowered text, each run of other characters than letters as one space."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
    codes = np.where(letters()[codes], codes, np.uint32(32))
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    return codes[keep]


def grams(codes: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each place."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.empty(0, np.uint32)
    mixed = np.full(n, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for i in range(order):
        mixed = (mixed ^ codes[i : i + n]) * np.uint32(0x85EBCA6B)
        mixed ^= mixed >> np.uint32(13)
    return (mixed * np.uint32(0xC2B2AE35)) >> np.uint32(16)


@dataclass
class LanguageModel:
    languages: list[str]
    values: np.ndarray  # (BUCKETS, languages): weight times idf times scale
    bias: np.ndarray
    temperature: float

    def logits(self, texts: list[str]) -> np.ndarray:
        """Uncalibrated logits of whole texts."""
        parts = [folded(t) for t in texts]
        sums = np.zeros((len(parts), len(self.languages)))
        sizes = np.zeros(len(parts))
        codes = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        lengths = np.array([len(p) for p in parts], np.int64)
        firsts = np.cumsum(lengths) - lengths
        for order in ORDERS:
            buckets = grams(codes, order)
            counts = np.maximum(lengths - order + 1, 0)
            owner = np.repeat(np.arange(len(parts)), counts)
            places = np.arange(counts.sum()) + np.repeat(firsts - (np.cumsum(counts) - counts), counts)
            for language in range(len(self.languages)):
                sums[:, language] += np.bincount(owner, self.values[buckets[places], language], len(parts))
            sizes += counts
        return sums / np.maximum(sizes, 1)[:, None] + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and calibrated probability; `und` and 0 for null or letterless texts."""
        known = [i for i, t in enumerate(texts) if t and has_letter(t)] if self.languages else []
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if known:
            logits = self.logits([texts[i] for i in known]) / self.temperature
            chances = np.exp(logits - logits.max(1, keepdims=True))
            chances /= chances.sum(1, keepdims=True)
            for i, best, chance in zip(known, chances.argmax(1), chances.max(1)):
                names[i], scores[i] = self.languages[best], float(chance)
        return names, scores


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket counts of the n-grams of each (lang, text)."""
    for batch in batches:
        rows = []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            codes = folded(text.as_py())
            buckets, counts = np.unique(np.concatenate([grams(codes, order) for order in ORDERS]), return_counts=True)
            rows.append((lang, buckets.astype("<u4").tobytes(), counts.astype("<u4").tobytes()))
        kinds = (pa.string(), pa.binary(), pa.binary())
        columns = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "buckets", "counts"])


def seen_by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, documents): how many texts of a task have an n-gram in each bucket."""
    documents, here = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, bool)
    for batch in batches:
        for text in batch.column("text"):
            codes = folded(text.as_py())
            for order in ORDERS:
                here[grams(codes, order)] = True
            found = np.flatnonzero(here)
            documents[found] += 1
            here[found] = False
    some = np.flatnonzero(documents)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(documents[some])], names=["bucket", "documents"])


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], seen: np.ndarray | None = None, documents: int = 0) -> LanguageModel:
    """The model of (language, buckets, counts) rows in memory.

    `seen` says for each bucket how many of the corpus' `documents` have it; without, the rows are
    the corpus.
    """
    languages = sorted({lang for lang, _, _ in rows})
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    order = np.random.default_rng(10).permutation(len(rows))
    rows = [rows[i] for i in order]
    if seen is None:
        seen, documents = np.zeros(BUCKETS), len(rows)
        for _, buckets, _ in rows:
            seen[buckets] += 1
    idf = np.log((1 + documents) / (1 + seen)) + 1
    examples = [(languages.index(lang), b, SCALE * idf[b] * c / c.sum()) for lang, b, c in rows]
    fitted = [e for i, e in enumerate(examples) if i % CALIBRATED] or examples
    checked = examples[::CALIBRATED]
    k = len(languages)
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))

    def weights(at) -> np.ndarray:
        over = np.abs(z[at]) > LASSO
        return np.where(over, -(z[at] - np.sign(z[at]) * LASSO) / ((BETA + np.sqrt(n[at])) / ALPHA + RIDGE), 0.0)

    for _ in range(EPOCHS):
        for label, buckets, values in fitted:
            at, x = np.append(buckets, BUCKETS), np.append(values, 1.0)
            w = weights(at)
            logits = x @ w
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[label] -= 1.0
            gradient = x[:, None] * chance[None, :]
            square = gradient**2
            sigma = (np.sqrt(n[at] + square) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - sigma * w
            n[at] += square
    w = weights(slice(None))
    logits = np.array([x @ w[b] + w[BUCKETS] for _, b, x in checked])
    labels = np.array([label for label, _, _ in checked])

    def loss(temperature: float) -> float:
        scaled = logits / temperature
        top = scaled.max(1)
        return float(np.mean(top + np.log(np.exp(scaled - top[:, None]).sum(1)) - scaled[np.arange(len(labels)), labels]))

    temperature = min(np.geomspace(0.05, 20, 121), key=loss)
    return LanguageModel(languages, (w[:BUCKETS] * idf[:, None] * SCALE).astype(np.float32), w[BUCKETS], float(temperature))


def fit(
    docs: DataFrame,
    per_language: int = SAMPLE_PER_LANGUAGE,
    languages: int = MOST_LANGUAGES,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> LanguageModel:
    """A model of about `per_language` documents of each language outside the held-out fold.

    The `languages` with the most documents are learned, which bounds the model where the
    column is dirty. Rows that have a bucket are counted over all rows, in each task before the shuffle. The sample is drawn by a hash of id and text at the rate each
    language needs, so rare languages are learned too; rows equal in both are one there. Only the
    counters of the buckets and the bucket counts of the sample reach the driver. Rows without id,
    text or language don't count; without any, every text is `und`.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang"))
    rows = rows.where((fold_of(F.col("doc_id")) != HELD_FOLD) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    marks = rows.select("lang", F.xxhash64("doc_id", "text").alias("mark"))
    counted_sizes, path = staged(marks.groupBy("lang").agg(F.count(F.lit(1)).alias("all"), F.approx_count_distinct("mark").alias("distinct")), "languages")
    documents = counted_sizes.agg(F.sum("all")).first()[0]
    sizes = counted_sizes.orderBy(F.desc("all"), "lang").limit(languages).collect()
    remove(docs.sparkSession, path)
    if not sizes:
        return train([])
    shares = {r.lang: min(1.0, per_language / r["distinct"]) for r in sizes}
    seen = np.zeros(BUCKETS)
    for r in rows.select("text").mapInArrow(seen_by_task, _SEEN).groupBy("bucket").agg(F.sum("documents").alias("documents")).collect():
        seen[r.bucket] = r.documents
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(10)), F.lit(1_000_000)) / 1e6
    wanted: Column = F.lit(False)
    for lang, share in shares.items():
        wanted = wanted | ((F.col("lang") == F.lit(lang)) & (draw < F.lit(float(share))))
    sample = rows.where(wanted).distinct().select("lang", "text").mapInArrow(counted, _COUNTS).collect()
    ordered = sorted(sample, key=lambda r: (r.lang, bytes(r.buckets), bytes(r.counts)))
    examples = [(r.lang, np.frombuffer(r.buckets, "<u4"), np.frombuffer(r.counts, "<u4").astype(float)) for r in ordered]
    return train(examples, seen, documents)


def identified(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, from its whole text alone.

    Null, empty and letterless texts are `und` with score 0. A null id is in no fold; repeated
    rows stay; an empty table gives no rows; other columns are not read. The model, bounded by
    its buckets and languages, travels with the tasks.
    """
    held = F.coalesce(fold_of(F.col(id_column)) == HELD_FOLD, F.lit(False))
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text_column).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in text_slices(whole, "text", SLICE_CHARS)):
            names, scores = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return narrow.mapInArrow(rows, _FOUND)


def told(docs: DataFrame, model: LanguageModel, least: float = 0.5, text_column: str = "text") -> DataFrame:
    """The rows of `docs` whose language is known with a score of `least` or more, all columns kept.

    Null, empty and letterless texts are of no known language and go; repeated rows stay or go
    together; rows with a null id are judged as all others; an empty table gives no rows.
    """
    place = docs.columns.index(text_column)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, whole.schema.names[place], SLICE_CHARS):
                names, scores = shared.value.predict(batch.column(place).to_pylist())
                yield batch.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, scores)], pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
