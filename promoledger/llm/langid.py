"""Language identification by rank-order profiles and out-of-place distance.

A profile is the list of the most frequent 1- to 3-grams of letters, most
frequent first; a word border counts as a letter. A text's own profile is
compared to each language's: every n-gram adds how far its rank is out of place,
or the full profile length where the language's profile lacks it. The language
of least distance wins; the score is one minus its distance's share of the
largest distance possible.

Cases: null texts and texts without a letter are ``und`` with score 0; without
any learned language every text is; repeated rows are treated alike; rows of null
language teach nothing; ties go to the language that sorts first, and equally
frequent n-grams rank by their code; an input column called like an output
column is replaced.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promoledger.llm.common import fold, hash_share, table, with_outputs
from promoledger.session import stage

#: Length of a profile.
TOP = 300
#: Bound of the fitting sample: so many documents of each language are expected in it.
SAMPLE_PER_LANGUAGE = 4_000
UNKNOWN = "und"
_PIECE = 1 << 20


def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def gram_counts(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of a text's 1- to 3-grams; 21 bits a letter, a border being 1, so no two n-grams share a code.

    Long texts are counted in pieces that overlap by two letters.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    code = np.concatenate([[1], np.where(letters[points], points, 1), [1]]).astype(np.int64)
    code = code[np.concatenate([[True], (code[1:] != 1) | (code[:-1] != 1)])]
    if len(code) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, counts = [], []
    for at in range(0, len(code) - 2, _PIECE):
        c = code[at + 2 : at + 2 + _PIECE]
        a, b = code[at : at + len(c)], code[at + 1 : at + 1 + len(c)]
        pairs = (a << 21) | b
        grams = [b[b != 1], pairs, ((pairs << 21) | c)[b != 1]]
        if at + _PIECE >= len(code) - 2:
            grams.append((code[-2:-1] << 21) | code[-1:])
        one, number = np.unique(np.concatenate(grams), return_counts=True)
        found.append(one), counts.append(number)
    if len(found) == 1:
        return found[0], counts[0]
    codes, where = np.unique(np.concatenate(found), return_inverse=True)
    return codes, np.bincount(where, np.concatenate(counts)).astype(np.int64)


def ranked(codes: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The ``top`` most frequent codes, most frequent first, ties by code."""
    return codes[np.lexsort((codes, -counts))[:top]] if len(codes) <= top else _best(codes, counts, top)


def _best(codes: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    least = np.partition(counts, len(counts) - top)[len(counts) - top]
    some = counts >= least
    codes, counts = codes[some], counts[some]
    return codes[np.lexsort((codes, -counts))[:top]]


def _count_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """n-gram counts by language; one merged table a batch."""
    letters = letter_table()
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            total: pd.Series | None = None
            parts, size = [], 0
            for text in texts:
                codes, counts = gram_counts(text or "", letters)
                parts.append(pd.Series(counts, codes))
                size += len(codes)
                if size > 500_000:
                    total = pd.concat([*parts, *([total] if total is not None else [])]).groupby(level=0).sum()
                    parts, size = [], 0
            total = pd.concat([*parts, *([total] if total is not None else [])]).groupby(level=0).sum()
            yield pd.DataFrame({"lang": lang, "gram": total.index.astype(np.int64), "n": total.to_numpy(np.int64)})


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE, top: int = TOP) -> dict[str, np.ndarray]:
    """Profile of each language, from about ``per_language`` documents each at most.

    A document is in the sample if its id's hash falls below its language's share,
    so no ranking is needed and no language's rows meet in one task. What comes
    back is ``top`` codes a language.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = known.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    # Written, so that Spark knows how small this is and needs no shuffle of texts.
    sizes, _ = stage(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "languages")
    sample = rows.join(sizes, "lang").where(hash_share("id") < F.lit(per_language) / F.col("rows"))
    counted = sample.select("lang", "text").mapInPandas(_count_partition, "lang string, gram long, n long")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    profiles = totals.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    found = profiles.toPandas().sort_values(["lang", "rank"])
    return {lang: part["gram"].to_numpy(np.int64) for lang, part in found.groupby("lang")}


class Profiles:
    """Learned profiles laid out for lookups: for each known n-gram its rank in every language."""

    def __init__(self, profiles: dict[str, np.ndarray], top: int = TOP):
        self.names = sorted(profiles)
        self.top = top
        self.grams = np.unique(np.concatenate([np.zeros(0, np.int64), *profiles.values()]))
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, np.int64)
        for i, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.grams, profiles[name]), i] = np.arange(len(profiles[name]))

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a ranked list of codes to each language."""
        at = np.searchsorted(self.grams, own)
        known = (at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] == own)
        theirs = self.ranks[np.where(known, at, len(self.grams))]
        apart = np.abs(theirs - np.arange(len(own))[:, None])
        return np.where(theirs < 0, self.top, apart).sum(axis=0)


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], text_col: str = "text", top: int = TOP, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language and its score; each whole text is profiled where it lies."""

    @F.arrow_udf("lang_pred string, score double")
    def nearest(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        letters, known = letter_table(), Profiles(profiles, top)
        for column in texts:
            names, scores = [], []
            for text in column.to_pylist():
                own = ranked(*gram_counts(text, letters), top) if text and known.names else ()
                if len(own):
                    apart = known.distances(own)
                    best = int(apart.argmin())
                    names.append(known.names[best])
                    scores.append(1 - float(apart[best]) / (top * len(own)))
                else:
                    names.append(UNKNOWN)
                    scores.append(0.0)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    found = docs.select(*with_outputs(docs, names), nearest(F.col(text_col)).alias("__found"))
    kept = with_outputs(found, ["__found"])
    return found.select(*kept, F.col("__found.lang_pred").alias(names[0]), F.col("__found.score").alias(names[1]))


def query(spark, sf_dir: str) -> DataFrame:
    """op5: every document's language by profiles that never saw the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    profiles = fit(docs.where(fold("doc_id", 3) != 1).select("doc_id", "text", "lang"))
    found = identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
