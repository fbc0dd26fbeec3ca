"""Language identification by compression with one zstandard raw-content dictionary for each language.

The case-folded text is compressed in chunks with every dictionary; the language whose
dictionary leaves the fewest bytes is chosen.  The margin to the second is
reported; where it is narrow the answer is marked as rejected.
"""

from __future__ import annotations

import math

import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import sample
from cadastra.llm.arrow import score_texts
from cadastra.llm.common import remainder, table
from cadastra.llm.zdict import Dictionaries

#: Bound of the sample: texts of each language and characters of each (fewer where sample.MOST_CHARS says so); bytes of each dictionary.
PER_LANG, CHARS, DICT_BYTES = 512, 4096, 64_000
#: Relative margin below which an answer is rejected; how steeply the margin turns into a score.
NARROW, STEEP = 0.01, 60.0
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


class LanguageModel:
    def __init__(self, texts: dict[str, list[str]]):
        self.dictionaries = Dictionaries({k: [t.lower() for t in v] for k, v in texts.items() if v}, DICT_BYTES) if any(texts.values()) else None

    def predict(self, text: str) -> tuple[str, float, float, bool]:
        """Language, score, margin, rejected.

        Without a letter, or where no language was learnt: `und`, 0, 0, rejected.
        Equal sizes: the first language in order of name.  The score is a
        softmax over the negative relative sizes.
        """
        if self.dictionaries is None or not LETTER.search(text):
            return UNKNOWN, 0.0, 0.0, True
        sizes = self.dictionaries.sizes(text.lower().encode())
        least = min(sizes)
        order = sorted(sizes)
        margin = (order[1] - least) / order[1] if len(order) > 1 else 1.0
        share = 1 / sum(math.exp(-STEEP * (s - least) / least) for s in sizes)
        return self.dictionaries.labels[sizes.index(least)], share, margin, margin < NARROW


def fit(docs: DataFrame, lang: str = "lang", key: str = "doc_id", text: str = "text") -> LanguageModel:
    """Fit on rows with text, language and key; the sample is bounded for each language and in all, whatever their number."""
    usable = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    texts, chars = sample.bounds(usable.select(lang).distinct().count(), PER_LANG, CHARS)
    picked = sample.chosen(usable, key, lang, texts)
    return LanguageModel({k: [t for _, t in v] for k, v in sample.texts(usable, picked, key, text, chars, label=lang).items()})


def predict(docs: DataFrame, model: LanguageModel, keep: list, text: str = "text") -> DataFrame:
    """The columns `keep` with lang_pred, score, margin and rejected, for each whole text; a null text is `und`.  No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return shared.value.predict

    return score_texts(docs, keep, text, "lang_pred string, score double, margin double, rejected boolean", make)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(remainder("doc_id", 4) != 2))
    return predict(docs, model, [F.col("doc_id"), (remainder("doc_id", 4) == 2).alias("held_out")])
