"""A training corpus from ``documents``: language, near copies, repeated passages, source weights, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again for the next. All but
the last return the columns of documents, one row a document; after mixing, a document that the mix takes twice has two
rows. Texts of any length pass whole, an empty table as an empty one, and columns that documents has besides its own, of
whatever name, as they are; each stage states what becomes of nulls, ties and repeated rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.llm import language, mixing, ngram_join, passages, sentencepieces
from civicspark.llm.frames import materialize

#: Below this mean probability a text is in none of the learned languages; that of a guess among four is 0.25. It is meant
#: for other languages: of the 10,000 documents at sf0.1, all in a learned one, none falls under it (the least is 0.307).
LEAST_SCORE = 0.3


def _packed(docs: DataFrame) -> DataFrame:
    """The id, the text, and all columns but these in one, so that no name meets those of an operator or a stage."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others).alias("_others"))


def _unpacked(rows: DataFrame, docs: DataFrame, **given: Column) -> DataFrame:
    """The columns of ``docs``, as they are but for those given."""
    own = {"doc_id": F.col("doc_id"), "text": F.col("text"), **given}
    return rows.select([own[c].alias(c) if c in own else F.col("_others").getField(c).alias(c) for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay, with that language where they had none.

    Null texts, empty ones and those without a letter go, as do texts of a probability under ``LEAST_SCORE``. Ties between
    languages go to the first by name; repeated rows each stay; null ids and sources stay null.
    """
    found = language.identify(_packed(docs), language.learn(docs), carry=("text", "_others")).where(
        (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    )
    return _unpacked(found, docs, lang=F.coalesce("_others.lang", "lang_pred"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked rows one row stays: that of the smallest id, of equal ids that of the smallest hash.

    Null ids are larger than all others: a row with one stays if its component has no other ids, and then alone. Of rows
    that are equal in all columns one stays. Rows without words are linked with nothing, and all stay.
    """
    values = [F.col("doc_id"), F.col("text"), *[F.col("_others").getField(c) for c in docs.columns if c not in ("doc_id", "text")]]
    packed = _packed(docs).withColumn("_row", F.xxhash64(*[x for c in values for x in (c.isNull(), c)]))
    found = ngram_join.join(packed.select("doc_id", "text", "_row"), carry=("_row",))
    rows = found.groupBy("component", "doc_id", "_row").agg(F.count("*").alias("_n"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row", "_n")).alias("least")
    first = rows.where("component IS NOT NULL").groupBy("component").agg(least).select(
        "least.doc_id", "least._row", (F.col("least._n") > 1).alias("_repeated")
    )
    wordless = rows.where("component IS NULL").select("doc_id", "_row", F.lit(False).alias("_repeated"))
    kept = materialize(first.union(wordless).toDF("_kept", "_kept_row", "_repeated"))
    matched = packed.join(kept, packed["doc_id"].eqNullSafe(kept["_kept"]) & (packed["_row"] == kept["_kept_row"]))
    # only rows that stand more than once are grouped
    once = matched.where("_repeated").dropDuplicates(["doc_id", "_row"])
    return _unpacked(matched.where("NOT _repeated").union(once), docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut; a document of which no letter or digit is left goes, unless nothing
    was cut from it.

    A null text becomes an empty one. Earlier is the smaller id, null last; rows of equal id, repeated ones too, aren't cut
    against each other.
    """
    found = passages.remove_repeats(_packed(docs), carry=("_others",), decode=True)
    left = found.where((F.size("spans") == 0) | F.col("kept").rlike(r"[\p{L}\p{N}]"))
    return _unpacked(left, docs, text=F.col("kept"), n_chars=F.length("kept").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, to the nearest whole number, 0, 1 or 2 times, in the order of the mix:
    a copy stands where its first words have their slot.

    Documents without words (null texts too) aren't taken. Null is a source like any other, the last. Rows that repeat an
    id and text are each written as often as they are taken on average; ties in the order go by id and text.
    """
    mixed = mixing.mix(docs.select("doc_id", "text", "source")).documents
    often = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0)
    times = mixed.groupBy(F.col("doc_id").alias("_id"), "_tie").agg(
        F.round(F.avg(often)).cast("int").alias("_times"), F.min("slots").alias("_slots")
    ).where("_times > 0")
    packed = _packed(docs)
    joined = packed.join(times, packed["doc_id"].eqNullSafe(times["_id"]) & (F.xxhash64(packed["text"]) == times["_tie"]))
    copies = joined.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)))
    placed = copies.withColumn("_slot", F.coalesce(F.get("_slots", F.col("_copy")), F.element_at("_slots", 1)))
    return _unpacked(placed.orderBy("_slot", "doc_id", "_tie"), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with digests of the ids and of the text that they decode to.

    A null text has no ids and decodes to an empty one; repeated rows have a row each.
    """
    found = sentencepieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", cut_repeated_passages),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]
#: Trained models, segmentation and hashing of whole corpora aren't SQL; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
