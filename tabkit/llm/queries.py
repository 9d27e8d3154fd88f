"""The registered queries of the text operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.llm import (
    alignment,
    bpe,
    decontaminate,
    fingerprints,
    packing,
    personal,
    repeats,
    runs,
    shards,
    simhash,
    toxicity,
    urls,
    warc,
)
from tabkit.llm.common import hex_sha256, table
from tabkit.runtime import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and the text they decode to."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode(docs, tokenizer_file(), decoded="decoded").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        hex_sha256(F.col("decoded")).alias("decoded_sha256"),
    )


@query()
def op3_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes, equal texts together."""
    placed = shards.shard_by_bytes(table(spark, folder, "documents"), 16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(rf"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    ), i AS (
      SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
    ), win AS (
      SELECT DISTINCT item_id, least(len(w), 13) AS m,
             array_to_string(w[pos : pos + least(len(w), 13) - 1], ' ') AS s
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS pos FROM i WHERE len(w) > 0)
    ), grams AS (
      SELECT doc_id, m, pos, array_to_string(w[pos : pos + m - 1], ' ') AS s
      FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS pos
            FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)
    ), hits AS (
      SELECT doc_id, item_id, pos, m FROM grams JOIN win USING (m, s)
    ), n_hit AS (
      SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(pos, pos + m)) AS p FROM hits) GROUP BY doc_id
    ), found AS (
      SELECT doc_id, count(DISTINCT item_id) AS n_items,
             string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN n_hit USING (doc_id) LEFT JOIN found USING (doc_id)
""")
def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document inside any benchmark window of 13 words."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        hex_sha256(F.concat_ws(",", "items")).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


@query()
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash of every document over 3-word shingles and its component at 2 bits or fewer."""
    found = simhash.near_duplicates(table(spark, folder, "documents"), words=3, radius=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query()
def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Syncmer fingerprints of every document and of its edited text."""
    return fingerprints.digest_columns(fingerprints.compare_with_edits(table(spark, folder, "documents")))


@query(r"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), win AS (
      SELECT doc_id, pos, array_to_string(w[pos : pos + 12], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS pos FROM d)
    ), first AS (
      SELECT s, min(doc_id) AS first FROM win GROUP BY s
    ), gone AS (
      SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS p FROM win JOIN first USING (s) WHERE doc_id > first
    ), kept AS (
      SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n_kept
      FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d)
      ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)
""")
def op2_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the passages of 13 words that an earlier document has as well."""
    found = repeats.find_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    kept = repeats.keep_words(found)
    return kept.select("doc_id", "n_words", "n_removed", hex_sha256(F.col("kept")).alias("kept_sha256"))


@query()
def op5_personal(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: counts and spans of the rules, and all spans."""
    found = personal.find_personal(table(spark, folder, "documents").select("doc_id", "text"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(i).alias(f"n_{kind}") for i, kind in enumerate(personal.KINDS)),
        hex_sha256(personal.as_text(F.col("base"))).alias("base_sha256"),
        personal.as_text(F.col("spans")).alias("spans"),
    )


@query(r"""
    WITH p AS (
      SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
             sha256(coalesce(html, '')) AS payload_digest
      FROM pages
    ), o AS (
      SELECT payload_digest, min(page_id) AS owner FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id <> owner THEN owner END AS refers_to
    FROM p LEFT JOIN o USING (payload_digest)
""")
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as WARC records, copies as revisits, and read back."""
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.page_records(table(spark, folder, "pages")), path)

    def page(column: str):
        return F.regexp_extract(column, "^<urn:page:(.*)>$", 1).try_cast("long")

    return warc.resolved(spark, path).select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


@query()
def op10_urls(spark: SparkSession, folder: str) -> DataFrame:
    """A verdict for every page: its longest rule's, else that of trust over the host graph."""
    return urls.judge(table(spark, folder, "pages"), RULES)


@query()
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of the rows that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    scored = toxicity.with_score(docs, model, name="score")
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query()
def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in every document, one in ten of them with a planted end."""
    docs = runs.with_planted_runs(table(spark, folder, "documents").select("doc_id", "text"))
    found = runs.find_runs(docs, collapsed="kept").withColumn("best", runs.strongest(F.col("runs")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        hex_sha256(runs.as_lines(F.col("runs"))).alias("runs_sha256"),
        hex_sha256(F.col("kept")).alias("collapsed_sha256"),
    )


@query()
def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as pieces of full sequences of 2,048 tokens."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, tokenizer_file("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query()
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of two tokenizers that end together, in every document and counted over all of them."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows, _ = alignment.align(docs, tokenizer_file(), tokenizer_file("piece_bpe_32k.model"))
    return rows.select("doc_id", *alignment.MEASURES, "groups_sha256")
