"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs.  All but the last keep the
columns of documents, whatever other columns there are and whatever their names.
Texts of any length are handled whole; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from scissile.llm import byte_cnn, near_copies, packing, suffix_dedup, winnow
from scissile.llm.queries import table, tokenizer_paths
from scissile.llm.storage import fresh_name, settled

#: A language is told if its score is so much of the way from chance (one over the languages) to certainty.  Of 51282
#: rows of the check's small input 2 are below that, and 9 at twice as much, among them short clean ones.
LEAST_SURE = 0.1


def least_score(languages: int) -> float:
    chance = 1 / max(1, languages)
    return chance + LEAST_SURE * (1 - chance)


def language(spark, docs, sf_dir):
    """Documents go that have no letter (null and empty texts among them), or whose language the network can't tell; repeated rows share their fate."""
    model = byte_cnn.fit(docs)
    lang, score = fresh_name(docs, "lang"), fresh_name(docs, "score")
    seen = byte_cnn.identify(docs, model, (lang, score))
    return seen.where((F.col(lang) != "und") & (F.col(score) >= least_score(len(model.names)))).select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """The document with the smallest doc_id of each group of near duplicates stays: texts with 0.8 of their five-word shingles in common.

    Of rows that share that doc_id and their text one stays; a null doc_id stays only in groups that have no other, a row a shingle set.
    """
    return near_copies.keep_first(docs).select(*docs.columns)


def repeated_passages(spark, docs, sf_dir):
    """Passages that an earlier document has are cut out; characters that a cut splits go with it.

    Rows with a null doc_id are left alone; null texts stay null; rows of one doc_id aren't cut for each other.
    """
    kept, removed, runs = (fresh_name(docs, x) for x in ("kept", "removed", "runs"))
    out = suffix_dedup.remove_repeats(docs, names=(kept, removed, runs))
    left = F.replace(F.make_valid_utf8(F.col(kept).cast("string")), F.lit("\ufffd"), F.lit(""))
    cut = F.col(removed) > 0
    out = out.withColumn("text", F.when(cut, left).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(cut, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def decontaminate(spark, docs, sf_dir):
    """Documents that hold benchmark passages go; those with null or wordless texts stay, and repeated rows share their fate."""
    name = fresh_name(docs, "bench")
    found = winnow.find_contamination(docs, table(spark, sf_dir, "benchmark"), name=name)
    return found.where(~winnow.is_contaminated(F.col(name))).select(*docs.columns)


def packed(spark, docs, sf_dir):
    """Pieces of documents in sequences of 2048 tokens; a null text is its end token, repeated rows are packed each."""
    return packing.pack(docs, *tokenizer_paths())


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("decontaminate", decontaminate), ("packed", packed)]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(lambda docs=docs, stage=stage: stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
