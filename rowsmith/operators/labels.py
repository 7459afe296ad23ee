"""Label scan for label sets that are a table.

``text.extract_label`` puts its labels into the plan, which suits a handful. Here the labels
are rows: the words of an answer, each once and numbered in order, meet the cleaned labels
in a join, and the label of the first word that is one wins (``min_by`` on the number).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

#: Ways in which a word is split: one that every answer has is spread over so many join keys.
SALTS = 16


def labels_from_table(
    answers: DataFrame, text_col: str, labels: DataFrame, label_col: str = "label", order_col: str | None = None, name: str = "label", remove_thinking: bool = True
) -> DataFrame:
    """``answers`` with the label of the first word (in text order) whose cleaned form is a cleaned label.

    The label comes as it stands in the table; of labels that clean alike the one with
    the least ``order_col`` wins (the least label without one). A null answer, and one
    without a hit, give null; a label without a word character matches nothing. Equal
    answers are scanned once, so repeated rows cost nothing and no key is needed.
    """
    rank = F.col(f"`{order_col}`") if order_col else F.col(f"`{label_col}`")
    cleaned = labels.select(X.clean_word(F.col(f"`{label_col}`")).alias("_word"), F.struct(rank.alias("r"), F.col(f"`{label_col}`").alias("l")).alias("_label"))
    known = cleaned.filter(F.col("_word") != "").groupBy("_word").agg(F.min("_label").alias("_label")).select("_word", F.col("_label.l").alias("_label"))
    known = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    text = F.col(f"`{text_col}`")
    spoken = X.strip_thinking(text) if remove_thinking else text
    # As in the small form: the whole text is cleaned at once. Order survives ``array_distinct``.
    words = F.array_distinct(X.words(F.lower(F.regexp_replace(spoken, X.NOT_WORD_OR_SPACE, ""))))
    key = F.sha2(text, 256)
    texts = answers.select(key.alias("_key"), words.alias("_words")).filter(F.size("_words") > 0).dropDuplicates(["_key"])
    said = texts.select("_key", F.posexplode("_words").alias("_at", "_word")).withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int"))
    first = said.join(known, ["_word", "_salt"]).groupBy("_key").agg(F.min_by("_label", "_at").alias("_found"))
    kept = [F.col(f"`{c}`") for c in answers.columns if c.lower() != name.lower()]
    return answers.withColumn("_key", key).join(first, "_key", "left").select(*kept, F.col("_found").alias(name))
