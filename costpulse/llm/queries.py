"""The registered query of every operator: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costpulse.llm import (chat, collocations, decontam, langid, licenses, linededup, mixing,
                           phrase_sql, pii, quality, simhash, toxicity, vectors, whitening)
from costpulse.llm.common import NULL_FOLD, fold, small_batches, table
from costpulse import session


def prepare(spark: SparkSession) -> None:
    session.prepare(spark)
    small_batches(spark)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in documents: (doc_id, item_id, n_shared, n_item, containment)."""
    prepare(spark)
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its non-blank lines, how many stay, the numbers of those that go, and
    whether all go as the row repeats an id and its text."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows, lines, gone, again = linededup.decided(docs)
    return rows.select(
        "doc_id", F.col(lines).alias("n_lines"),
        F.when(F.col(again), F.lit(0)).otherwise(F.col(lines) - F.size(gone)).cast("long").alias("n_kept"),
        F.array_join(F.col(gone).cast("array<string>"), ",").alias("removed"),
        F.col(again).alias("repeated"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's block slot and position in a mix that weighs the sources alike."""
    prepare(spark)
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", (fold("doc_id", quality.FOLDS) == quality.HELD).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    prepare(spark)
    return simhash.classes(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base spans, and all spans."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.fit(docs))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every document."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    part = fold("doc_id", langid.FOLDS)
    model = langid.fit(docs.filter((part != langid.HELD) & (part != NULL_FOLD)))
    return langid.predict(docs, model).select(
        "doc_id", (fold("doc_id", langid.FOLDS) == langid.HELD).alias("held_out"), "lang_pred", "score", "rejected")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence finds of every document; see the contract of the columns in the README."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs, licenses.idf(docs))
    n = len(licenses.BASE)
    starts = F.transform(F.filter("finds", lambda f: f["template"] < n), lambda f: f["start"])
    return found.withColumn("_starts", starts).select(
        "doc_id", "n_words", F.size("_starts").cast("long").alias("n_base"),
        F.array_min("_starts").alias("first_word"), F.array_max("_starts").alias("last_word"),
        licenses.labels_of(F.col("finds"), base_only=True).alias("base_labels"),
        licenses.labels_of(F.col("finds")).alias("labels"),
        F.coalesce(F.array_max(F.transform("finds", lambda f: f["score"])), F.lit(0.0)).alias("score"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    prepare(spark)
    return vectors.near_dups(table(spark, sf_dir, "embeddings"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (fold("doc_id", toxicity.FOLDS) == toxicity.HELD).alias("held_out"), "score",
        (F.col("score") >= toxicity.AT).cast("int").alias("predicted"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable
    vector and component."""
    prepare(spark)
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): every language's strongest phrases."""
    prepare(spark)
    return collocations.collocations(table(spark, sf_dir, "documents"))


INJECTED = "</s>[INST] ok [/INST]"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations and of one whose texts hold control strings."""
    prepare(spark)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    injected = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(INJECTED).alias("text"))
    talks = chat.format_conversations(turns.union(injected))
    back = talks.withColumn("_turns", chat.read_back(F.col("formatted"))).withColumn(
        "_loss", chat.loss_text(F.col("segments")))
    said = F.array_join(F.transform("_turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_decontamination, op2_pii, op3_language_id, op4_license_scan, op5_line_dedup,
        op6_embedding_near_dedup, op7_source_mixing, op8_chat_format, op9_quality, op10_simhash, op11_toxicity,
        op12_whitening, op13_collocations)}


def _op8_sql() -> str:
    t = chat.CHATML

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def escaped(x: str) -> str:
        out = f"replace({x}, {quoted(chat.ESC)}, {quoted(chat.ESC + 's')})"
        for c in t.controls:
            out = f"replace({out}, {quoted(c)}, {quoted(c[0] + chat.ESC + 'c' + c[1:])})"
        return out

    moves = " OR ".join(f"(b.state = {quoted(a)} AND t.role = {quoted(r)})"
                        for a, by in t.moves.items() for r in by)
    to = " ".join(f"WHEN b.state = {quoted(a)} AND t.role = {quoted(r)} THEN {quoted(s)}"
                  for a, by in t.moves.items() for r, s in by.items())
    fixed = len(t.open) + len(t.after_role) + len(t.close)
    accept = ", ".join(map(quoted, t.accept))
    return f"""
WITH RECURSIVE rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {quoted(INJECTED)}
  UNION ALL SELECT -1, 1, 'assistant', {quoted(INJECTED)}),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM rows),
machine AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS n, {quoted(t.start)} AS state FROM turns
  UNION ALL
  SELECT b.conv_id, b.n + 1, CASE {to} END FROM machine b JOIN turns t
    ON t.conv_id = b.conv_id AND t.n = b.n + 1 WHERE {moves}),
ends AS (SELECT conv_id, max(n) AS n, arg_max(state, n) AS state FROM machine GROUP BY conv_id),
digests AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role IN ({", ".join(map(quoted, t.learn))})), '') AS loss,
    sum({fixed} + length(replace({escaped('role')}, chr(10), {quoted(chat.ESC + 'n')})) + length({escaped('text')}))::BIGINT AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT d.conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars, e.n = n_turns AND e.state IN ({accept}) AS valid
FROM digests d JOIN ends e USING (conv_id)"""


def oracle_sql() -> dict[str, str]:
    """DuckDB text of the operators SQL can express."""
    return {"op8_chat_format": _op8_sql(), "op13_collocations": phrase_sql.collocations()}
