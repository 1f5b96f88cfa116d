"""Registered queries of the corpus operators: thin callables (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tripstar.llm import (
    decontaminate, filter_audit, html_text, langid, packing, passages, quality, secrets, shards, simhash, token_files, url_lists, whitening,
)
from tripstar.llm.common import table
from tripstar.llm.oracles import ORACLE_SQL  # noqa: F401
from tripstar.paths import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_quality_rules(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.quality_rules(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_ngrams", "llr_fixed")


def op2_simhash_dedup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# The list log of the tables: what an event does to the pattern of the page that its user id names.
LIST_ACTIONS = {"error": ("block", "add"), "purchase": ("block", "remove"), "signup": ("allow", "add"), "view": ("allow", "remove")}


def list_entries(events, pages):
    """Dated list entries: the page's host, or its parent domain where the user id divides by five."""
    named = pages.select(F.col("page_id").alias("user_id"), url_lists.host_of(F.col("url")).alias("host"))
    kind, action = (F.create_map(*[F.lit(x) for k, v in LIST_ACTIONS.items() for x in (k, v[i])])[F.col("event_type")] for i in (0, 1))
    parent = F.regexp_replace("host", r"^[^.]*\.", "")
    return events.join(named, "user_id").select(
        kind.alias("list"), F.when(F.col("user_id") % 5 == 0, parent).otherwise(F.col("host")).alias("pattern"),
        action.alias("action"), F.col("ts").cast("timestamp").alias("since"))


# After an event's own entry, and after the entries of many others of its host.
FETCH_DELAY = "INTERVAL 12 HOURS"


def op3_url_lists(spark, sf_dir):
    """A capture for every event: the page that its user id names, fetched half a day after the event, so the
    captures lie over the whole list log. A page without an event is a capture without a time."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    moments = events.select(F.col("user_id").alias("page_id"), (F.col("ts").cast("timestamp") + F.expr(FETCH_DELAY)).alias("fetched_at"))
    found = url_lists.filter_urls(pages.join(moments, "page_id", "left"), list_entries(events, pages))
    return found.select("page_id", "url", "host", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("fetched_at"),
                        F.array_join("lists", ",").alias("lists"), "pattern", "blocked")


def op4_html_text(spark, sf_dir):
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op5_secret_scan(spark, sf_dir):
    return secrets.scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    # no remainder (a null id) is not held out and not learned from
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return langid.identify(docs, rest != 2).select(
        "doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "entropy", "rejected")


def op7_repeated_passages(spark, sf_dir):
    found = passages.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source")


def op9_decontamination(spark, sf_dir):
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_sharding(spark, sf_dir):
    placed = shards.assign_shards(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_token_files(spark, sf_dir):
    """Written once to token files, then read back from them."""
    path = scratch_path(spark, "llm-token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return token_files.id_checksums(token_files.read_tokens(spark, path))


def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_url_lists": op3_url_lists,
    "op4_html_text": op4_html_text,
    "op5_secret_scan": op5_secret_scan,
    "op6_language_id": op6_language_id,
    "op7_repeated_passages": op7_repeated_passages,
    "op8_packing": op8_packing,
    "op9_decontamination": op9_decontamination,
    "op10_sharding": op10_sharding,
    "op11_token_files": op11_token_files,
    "op12_filter_audit": op12_filter_audit,
    "op13_whitening": op13_whitening,
}
