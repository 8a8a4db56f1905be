"""From documents to token ids: toxicity, near duplicates, benchmark passages, personal data, BPE.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import bpe, decontam, minhash, pii, toxicity
from barloom.llm.queries import BPE_FILE, PII_KEY, table
from barloom.session import small_batches, staging_path
from barloom.session import stage as stage_table

# Rows of a side up to which it is broadcast; above it both sides are shuffled.
BROADCAST_ROWS = 500_000
# Pieces that an encoder remembers, beside executors that still hold the memory of the stages before.
PIECES = 100_000

# Learnt scores, hash signatures and merges have no SQL form; tests/llm states the stages plainly.
ORACLE_SQL = None


def _sized(side: DataFrame) -> DataFrame:
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def _free(docs: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``docs`` has."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def _columns(docs: DataFrame, alias: str | None = None) -> list[Column]:
    return [F.col(f"{alias}.`{c}`" if alias else f"`{c}`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; learnt on the labelled ones among them.

    Rows are judged one by one by their text: repeated rows share their fate, null and wordless texts
    and those of no known word stay, ids play no part but in learning. Other columns pass unchanged.
    """
    score = _free(docs, "toxic_score")
    with small_batches(spark):
        model = toxicity.learn(docs, table(spark, sf_dir, "labels").filter(toxicity.learnable()))
        scored = toxicity.score(docs, model, score_col=score)
    return scored.filter(F.col(score) < 0.5).select(*_columns(docs))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more.

    Texts are compared, whatever their ids; a group keeps one row of its smallest id, null last; of
    rows equal in id and text the smallest by its other columns. Texts without a word, and null ones,
    stay. Other columns pass unchanged.
    """
    rows = docs.select("doc_id", "text", F.md5("text").alias("print")).filter("text IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "n")).alias("first")
    prints = stage_table(
        rows.groupBy("print", "doc_id").agg(F.count("*").alias("n")).groupBy("print").agg(first)
        .select("print", "first.*").withColumn("number", F.monotonically_increasing_id()), "prints")
    found = stage_table(minhash.near_duplicates(
        rows.join(_sized(prints), "print").select("number", "text"), width=5, percent=80,
        id_col="number").select(F.col("doc_id").alias("number"), "n_shingles", "component_id").distinct(),
        "near")
    known = prints.join(found, "number")
    best = known.filter("n_shingles > 0").groupBy("component_id").agg(
        F.min(F.struct("unknown", "doc_id", "number", "print", "n")).alias("best"))
    kept = stage_table(best.select("best.print", "best.doc_id", "best.n"), "kept")

    def of(some: DataFrame) -> DataFrame:
        """(print, row): the rows of the prints and ids in ``some``."""
        same = (F.md5("docs.text") == F.col("kept.print")) & F.col("docs.doc_id").eqNullSafe(
            F.col("kept.doc_id"))
        return docs.alias("docs").join(_sized(some).alias("kept"), same).select(
            F.col("kept.print").alias("print"), F.struct(*_columns(docs, "docs")).alias("row"))
    # Only rows that share id and text with another one are folded.
    repeated = of(kept.filter("n > 1")).groupBy("print").agg(F.min("row").alias("row"))
    wordless = stage_table(known.filter("n_shingles = 0").select("print"), "wordless")
    blank = docs.alias("docs").join(_sized(wordless).alias("blank"),
                                    F.md5("docs.text") == F.col("blank.print"), "left_semi")
    return (of(kept.filter("n = 1")).union(repeated).select("row.*")
            .union(blank.select(*_columns(docs, "docs"))).union(docs.filter(F.col("text").isNull())))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages in a twentieth or more of their words, judged by text.

    Repeated rows share their fate whatever their ids; null and wordless texts stay. Other columns pass
    unchanged.
    """
    rows = docs.select("text", F.md5("text").alias("print"))
    found = decontam.contamination(rows, table(spark, sf_dir, "benchmark"), id_col="print")
    gone = found.filter("contaminated").select(F.col("doc_id").alias("print")).distinct()
    return docs.alias("docs").join(gone.alias("gone"), F.md5("docs.text") == F.col("gone.print"),
                                   "left_anti").select(*_columns(docs, "docs"))


def hide_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data as pseudonyms, ``n_chars`` made anew.

    Row by row: equal values get equal pseudonyms, so repeated rows stay repeated; null texts stay null
    (n_chars null too). Columns that bear the names of the finder's counts pass unchanged, as all others.
    """
    spare = {c: _free(docs, f"{c}_given") for c in docs.columns if c.lower() in ("n_pii", "pii_kinds")}
    hidden = pii.pseudonymise(docs.withColumnsRenamed(spare), PII_KEY)
    made = {"n_chars": F.char_length("text").cast("long").alias("n_chars")}
    return hidden.select(*(made[c] if c in made else F.col(f"`{spare.get(c, c)}`").alias(c)
                           for c in docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether decoding them gives the text back; one row per row, null as empty.

    Repeated rows give equal rows; extra columns of ``docs`` are not part of the result.
    """
    # Written between: encoders and decoders at work at once would double the memory of the workers. The
    # texts' digests go on in their place, so that a decoder's batch is half as large.
    whole = docs.select("doc_id", "lang", "source", "text",
                        F.sha2(F.coalesce("text", F.lit("")), 256).alias("whole"))
    with small_batches(spark):
        encoded = stage_table(bpe.encode(whole, BPE_FILE, remembered=PIECES, forget=True).drop("text"),
                              "encoded")
        # Written here, since what the caller writes would get Spark's own batches.
        return stage_table(bpe.decode(encoded, BPE_FILE).select(
            "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
            (F.sha2("decoded", 256) == F.col("whole")).alias("round_trip")), "decoded")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", keep_one_of_each),
          ("decontamination", drop_contaminated), ("pii", hide_personal), ("bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = staging_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
