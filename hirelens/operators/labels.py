"""Sentences and weak skill labels, the training input of a skill tagger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.fixed_values import SKILL_LEXICON
from hirelens.functions.skills import mentions_skill, skill_spans
from hirelens.functions.text import clean_text, split_sentences


def sentences(df: DataFrame, text: Column, *keep: str) -> DataFrame:
    """One row (keep..., pos, sentence) per sentence of the cleaned text, `pos` from 0."""
    return df.select(*keep, F.posexplode(split_sentences(clean_text(text))).alias("pos", "sentence"))


def label_sentences(df: DataFrame, text: Column, lexicon: Sequence[str] = SKILL_LEXICON) -> DataFrame:
    """(text, entities) for every different sentence that names a skill.

    Equal sentences have equal spans, so copies go before the spans are worked out.
    """
    found = (
        sentences(df, text)
        .select(F.col("sentence").alias("text"))
        .filter(mentions_skill(F.col("text"), lexicon))
        .distinct()
    )

    def entity(span: Column) -> Column:
        return F.struct(span["start"].alias("start"), span["end"].alias("end"), F.lit("SKILL").alias("label"))

    return found.select("text", F.transform(skill_spans(F.col("text"), lexicon), entity).alias("entities"))
