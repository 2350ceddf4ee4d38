"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed bigrams and trigrams of lower-cased letters (runs of
anything else are one blank) per language in every partition and sums them in
Spark; the log-probability matrix, buckets x languages, is broadcast.  Scoring
looks up the rows of a batch's grams and sums them per text, whole texts in
chunks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1 << 15
#: The broadcast matrix has BUCKETS x languages floats: at most 64 MB.
MAX_LANGUAGES = 512
SMOOTHING = 0.1
UNKNOWN = "und"
_CHUNK = 1 << 18


def _letters() -> np.ndarray:
    """Flag per code point: is it a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


_IS_LETTER: list[np.ndarray] = []


def grams(text: str) -> np.ndarray:
    """Buckets of the bigrams and trigrams of a text, in any order; empty if it
    has no letter."""
    if not _IS_LETTER:
        _IS_LETTER.append(_letters())
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _IS_LETTER[0][c]
    if not letter.any():
        return np.empty(0, np.int64)
    c = np.where(letter, c, 32)
    c = np.concatenate(([32], c[letter | np.concatenate(([True], letter[:-1]))], [32]))
    c = c.astype(np.uint32)
    two = (c[:-1] * np.uint32(0x9E3779B1)) ^ (c[1:] * np.uint32(0x85EBCA77))
    three = (two[:-1] * np.uint32(0xC2B2AE3D)) ^ (c[2:] * np.uint32(0x27D4EB2F))
    h = np.concatenate((two * np.uint32(0x165667B1), three * np.uint32(0x9E3779B1)))
    return (h >> np.uint32(17)).astype(np.int64) % BUCKETS


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray        # log prior per language
    table: np.ndarray        # log probability per bucket and language, float32

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and posterior per text; ``und`` and 0 without text or letters."""
        names, scores = [], []
        for text in texts:
            g = grams(text) if text and self.languages else ()
            if not len(g):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            total = self.prior.copy()
            for at in range(0, len(g), _CHUNK):
                total += self.table[g[at:at + _CHUNK]].sum(axis=0, dtype=np.float64)
            best = int(total.argmax())
            names.append(self.languages[best])
            scores.append(float(1.0 / np.exp(total - total[best]).sum()))
        return names, scores


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model of all rows with text and language.  Ties between languages go to
    the first in code-point order; without rows it knows no language."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = seen.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                own[BUCKETS] += 1          # texts of the language
                own[:BUCKETS] += np.bincount(grams(text), minlength=BUCKETS)
        for lang, own in seen.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                 pa.array(own[at], pa.int64())], names=["lang", "bucket", "n"])

    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    counts = (rows.mapInArrow(count, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    # at most (BUCKETS + 1) x MAX_LANGUAGES numbers, one array per language
    per = (counts.groupBy("lang").agg(F.collect_list("bucket").alias("bucket"),
                                      F.collect_list("n").alias("n"))
           .limit(MAX_LANGUAGES + 1).collect())
    if len(per) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    per.sort(key=lambda r: r["lang"])
    table = np.zeros((len(per), BUCKETS + 1))
    for row, r in zip(table, per):
        row[r["bucket"]] = r["n"]
    if not per:
        return Model([], np.zeros(0), np.zeros((BUCKETS, 0), np.float32))
    texts, hits = table[:, BUCKETS], table[:, :BUCKETS] + SMOOTHING
    return Model([r["lang"] for r in per], np.log(texts / texts.sum()),
                 np.ascontiguousarray(np.log(hits / hits.sum(axis=1, keepdims=True)).T, np.float32))


def predictor(spark: SparkSession, model: Model):
    """Column function: text -> struct(lang, score)."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(text: pa.Array) -> pa.Array:
        names, scores = shared.value.predict(text.to_pylist())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()),
                                           pa.array(scores, pa.float64())], ["lang", "score"])
    return predict


def held_out(id_col: Column) -> Column:
    """crc32 of the id's text mod 4 is 2; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score.

    Learns from rows that are not held out and have id, text and language.
    Null, empty and letterless texts are ``und`` with score 0, as is every
    text if there is nothing to learn from.  Repeated rows keep their row;
    empty input gives no rows; other columns are ignored."""
    known = docs.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    predict = predictor(docs.sparkSession, train(known, text_col, lang_col))
    return (docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"),
                        predict(F.col(text_col)).alias("p"))
            .select(F.col("id").alias(id_col), "held_out", F.col("p.lang").alias("lang_pred"),
                    F.col("p.score").alias("score")))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a language of at least that score, columns unchanged.

    Null, empty and letterless texts go, as does every row if there is nothing to learn
    from.  Rows without id or language are judged but not learned from; repeated rows
    and columns of any name stay as they are.  No rows give no rows."""
    known = docs.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    predict = predictor(docs.sparkSession, train(known, text_col, lang_col))
    names = [f"__c{i}" for i in range(len(docs.columns))]
    text = F.col(names[docs.columns.index(text_col)])
    return (docs.toDF(*names).withColumn("__p", predict(text))
            .where((F.col("__p.lang") != UNKNOWN) & (F.col("__p.score") >= least_score))
            .select(*names).toDF(*docs.columns))
