"""Enrichment runs over transcript tables: what is stale is embedded, classified, fed to an index, pruned."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstone.sources import schemas, tables

from . import enrich, vectors
from .providers import Completer

Frames = Mapping[str, DataFrame]
DAY = ["jurisdiction", "date", "house"]
PARTS = ["model_slug", *DAY]
#: The defaults of theme labels.
TOP_THEMES, LEAST_SCORE = 3, 0.25


def _slug(model: str) -> str:
    return re.sub("[^A-Za-z0-9._-]+", "-", model)


def embed_pending(frames: Frames, embedder: enrich.Embedder, root: str, model: str, provider: str = "") -> int:
    """Embed the texts of days that are new or changed since they were embedded; how many days.

    The signatures of what was embedded lie beside the vectors, so a day that
    is rewritten unchanged is skipped and a revised text embeds its day again.
    """
    texts = frames["texts"].where("trim(clean_text) <> ''").withColumn("date", F.col("date").cast("string"))
    spark = texts.sparkSession
    now = enrich.signatures(texts, DAY, "text_id", F.col("clean_text")).withColumn("model_slug", F.lit(_slug(model)))
    schema = "signature string, model_slug string, jurisdiction string, date string, house string"
    stored = spark.read.schema(schema).parquet(f"{root}/signatures") if tables.exists(spark, f"{root}/signatures") else spark.createDataFrame([], schema)
    path = tables.temporary_path(spark, "stale")
    enrich.stale(now, stored, PARTS).write.parquet(path)
    stale = spark.read.schema(now.schema).parquet(path)
    days = stale.count()
    if days:
        due = texts.join(stale.select(*DAY), DAY, "left_semi")
        made = enrich.embed_texts(due, embedder, "text_id", "clean_text")
        keys = due.select("text_id", "fragment_id", "talker_id", "subject_id", *DAY)
        rows = made.join(keys, "text_id").withColumns({"model": F.lit(model), "provider": F.lit(provider), "model_slug": F.lit(_slug(model))})
        tables.overwrite_partitions(rows.select(*(f.name for f in schemas.SIDE_TABLES["embeddings"])), f"{root}/embeddings", PARTS)
        tables.overwrite_partitions(stale.select("signature", *PARTS), f"{root}/signatures", PARTS)
    return days


def theme_documents(frames: Frames) -> DataFrame:
    """(subject_id, document, fragment_id and the day) of each subject with words."""
    subjects = frames["subjects"].select("subject_id", "fragment_id", *DAY, "name")
    texts = frames["texts"].where("subject_id is not null").select("subject_id", "document_order", "clean_text").join(subjects.select("subject_id", "name"), "subject_id")
    return enrich.theme_documents(texts, "subject_id", "name", "document_order", "clean_text").join(subjects.drop("name"), "subject_id")


def classify_pending(frames: Frames, taxonomy: DataFrame, root: str, model: str, *, embedder: enrich.Embedder | None = None, completer: Callable[[], Completer] | None = None, provider: str = "", top: int = TOP_THEMES, least: float = LEAST_SCORE, procedural: bool = False) -> int:
    """Label the subjects of days without labels by *model*; how many days.

    With an *embedder*, themes are ranked by the similarity of their name and
    description to a subject's document; with a *completer*, by the order in
    which a model's answer names them, without a score.  Procedural themes
    count only if asked for.
    """
    spark = taxonomy.sparkSession
    docs = theme_documents(frames).withColumn("date", F.col("date").cast("string"))
    done = tables.scan(spark, f"{root}/subject_themes", schemas.SIDE_TABLES["subject_themes"]).where(F.col("model_slug") == _slug(model)).select(*DAY).distinct()
    pending = docs.join(done, DAY, "left_anti")
    days = pending.select(*DAY).distinct().count()
    if not days:
        return 0
    themes = taxonomy if procedural else taxonomy.where("not procedural")
    engine = "embedding" if embedder else "llm"
    if embedder:
        said = F.concat_ws(" — ", "theme_name", "description")
        listed = enrich.embed_texts(themes.withColumn("said", said), embedder, "theme_id", "said").select("theme_id", "embedding")
        made = enrich.embed_texts(pending, embedder, "subject_id", "document").select("subject_id", "embedding")
        ranked = vectors.classify(made, listed, "subject_id", "theme_id", top, least)
    else:
        ids = [r.theme_id for r in themes.select("theme_id").orderBy("theme_id").collect()]  # a few dozen
        prompt = f"Name up to {top} of these themes that the debate is about, the main one first, by their ids only: {', '.join(ids)}.\n\n"
        ranked = enrich.answered_themes(answers(pending, completer, prompt), "subject_id", "answer", ids, top)
    names = themes.select("theme_id", "theme_name", F.col("locale").alias("taxonomy_locale"), F.col("version").alias("taxonomy_version"))
    rows = ranked.join(names, "theme_id").join(pending.select("subject_id", "fragment_id", *DAY), "subject_id")
    rows = rows.withColumns({"engine": F.lit(engine), "model": F.lit(model), "provider": F.lit(provider), "model_slug": F.lit(_slug(model)), "rank": F.col("rank").cast("int"), "score": F.col("score").cast("float")})
    tables.overwrite_partitions(rows.select(*(f.name for f in schemas.SIDE_TABLES["subject_themes"])), f"{root}/subject_themes", PARTS)
    return days


def answers(docs: DataFrame, completer: Callable[[], Completer], prompt: str) -> DataFrame:
    """(subject_id, answer) of a model, asked once a document from the executors."""
    import pyarrow as pa

    def ask(batches):
        complete = completer()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([complete(prompt + d) for d in batch.column(1).to_pylist()], pa.string())], names=["subject_id", "answer"])

    return docs.select("subject_id", "document").mapInArrow(ask, "subject_id string, answer string")


def citations(frames: Frames, embeddings: DataFrame) -> DataFrame:
    """(id, embedding, jurisdiction, payload) of each vector: where it was said and by whom, never what.

    Small tables are joined to one another first; keys come from the texts, and
    null fields are left out of the payload.
    """
    name = lambda table, key, alias: frames[table].select(key, F.col("name").alias(alias))
    bills = frames["bill_refs"].where("name is not null").groupBy("subject_id").agg(F.sort_array(F.collect_set("name")).alias("bill_names"))
    subjects = frames["subjects"].select("subject_id", F.col("proceeding_id").alias("_proceeding"), F.col("uid").alias("subject_uid"), F.col("name").alias("subject_name"), "committee_name", "extract_index").join(bills, "subject_id", "left")
    talkers = frames["talkers"].select("talker_id", F.col("name").alias("speaker"), "party", "party_abbreviation", "electorate", "role", F.col("kind").alias("talker_kind"))
    days = frames["fragments"].select("fragment_id", "parliament_num", "session_num", "review_stage", "source_url")
    texts = frames["texts"].select("text_id", "fragment_id", "subject_id", "subproceeding_id", "talker_id", F.col("proceeding_id").alias("_own"), *DAY, F.col("kind").alias("text_kind"), "page_no", F.date_format("time_anchor", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("time_anchor"))
    out = embeddings.select("text_id", "embedding").join(texts, "text_id").join(subjects, "subject_id", "left").join(talkers, "talker_id", "left").join(days, "fragment_id", "left")
    out = out.withColumn("proceeding_id", F.coalesce("_own", "_proceeding")).join(name("proceedings", "proceeding_id", "proceeding_name"), "proceeding_id", "left")
    out = out.join(name("subproceedings", "subproceeding_id", "subproceeding_name"), "subproceeding_id", "left").withColumn("date", F.col("date").cast("string"))
    fields = [c for c in out.columns if c not in ("embedding", "_own", "_proceeding")]
    return out.select(F.col("text_id").alias("id"), "embedding", "jurisdiction", F.to_json(F.struct(*fields)).alias("payload"))


def prune_partitions(spark: SparkSession, derived: str, source: str, keys: Sequence[str] = tuple(DAY)) -> list[str]:
    """Delete the partitions of *derived* whose days *source* no longer has; their paths."""
    if not tables.exists(spark, derived):
        return []
    have = tables.partition_values(spark, derived, ["model_slug", *keys])
    kept = tables.partition_values(spark, source, list(keys)) if tables.exists(spark, source) else have.limit(0)
    lost = enrich.orphans(have, kept, list(keys)).collect()  # days, not rows
    paths = ["/".join([derived, *(f"{c}={r[c]}" for c in ("model_slug", *keys))]) for r in lost]
    for path in paths:
        tables.delete(spark, path)
    return paths
