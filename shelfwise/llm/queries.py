"""The registered queries of the dealt operators, with the SQL that checks them."""

from __future__ import annotations

import uuid

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from shelfwise.llm import alignment, bpe, conversations, htmltext, langid, mixing, neardup, neighbours, oracles, packing, pii, simhash, suffixdedup, warc
from shelfwise.llm.common import read, shared_folder, stored

VOCABULARY = "byte_bpe_50k.json"


def op1_token_counts(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    counted = bpe.count_tokens(docs, public_tokenizers.path(VOCABULARY), limit=1024)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op2_near_duplicates(spark, folder):
    found = neardup.near_duplicates(read(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "fingerprint", "component_id")


def op3_source_mix(spark, folder):
    mixed = mixing.mix(read(spark, folder, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op4_fingerprints(spark, folder):
    """`n_near`: for ids divisible by 20, how many other fingerprints of the table lie
    within 3 bits of the document's; null for other ids."""
    found = stored(simhash.edited_fingerprints(read(spark, folder, "documents").select("doc_id", "text")), "fingerprints")
    asked = F.col("doc_id") % 20 == 0
    pairs = simhash.near(found.filter(asked), found, radius=3, blocks=5)
    counts = pairs.groupBy("query").agg((F.count("*") - 1).alias("n_near"))
    rows = found.join(counts, found["fingerprint"] == counts["query"], "left")
    return simhash.digest(rows, F.when(asked, F.col("n_near")).alias("n_near"))


def op5_language_id(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = langid.fold("doc_id") == 0
    model = langid.fit(docs.filter(~held_out))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op6_main_text(spark, folder):
    pages = read(spark, folder, "pages").select("page_id", "url", "html")
    weights = htmltext.fit(htmltext.labelled_sample(pages))
    return htmltext.extract(pages, weights).select("page_id", "url", "text", "n_chars")


def op7_embedding_near_duplicates(spark, folder):
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    found, _ = neighbours.near_duplicates(vectors, neighbours.Settings(threshold=0.93))
    return found.select("vec_id", "n_links", "component_id", "kept")


def op8_warc_captures(spark, folder):
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(read(spark, folder, "pages").select("page_id", "url", "html"), path, least_bytes=0)
    found = warc.records(spark, path)
    # The digests need the payloads once; only the metadata's block goes on.
    facts = stored(found.withColumns({
        "payload_digest": F.when(F.col("type") == "response", warc.base32_sha1(F.col("payload")))
        .otherwise(F.regexp_replace("payload_digest", "^sha1:", "")),
        "payload": F.when(F.col("type") == "metadata", F.col("payload"))}), "warc-records")
    captures = warc.page_ids(warc.assemble(facts))
    responses = captures.filter("type = 'response'").select(
        F.col("capture_id").alias("of"), F.col("page_id").alias("refers_to"))
    rows = captures.select(
        "page_id", F.col("http_length").alias("payload_bytes"), "payload_digest", F.col("type").alias("record_type"),
        F.col("refers_to").alias("_of"))
    return rows.join(responses, F.col("_of") == F.col("of"), "left").drop("_of", "of")


def op9_packing(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    # As many segments as tokens: only the length of a sequence binds.
    limits = packing.Limits(segments=packing.Limits.tokens)
    pieces = packing.pack_documents(docs, public_tokenizers.path(VOCABULARY), limits, separator=0)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_repeated_passages(spark, folder):
    found = suffixdedup.repeated_bytes(read(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_tokenizer_alignment(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return alignment.align(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.path("piece_bpe_32k.model"))


def op12_conversation_repair(spark, folder):
    rows = conversations.damage(read(spark, folder, "conversations"))
    return conversations.audit(rows)


def op13_personal_data(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs)
    return found.select("doc_id", *pii.digest(found))


def pipeline(spark, folder):
    return corpus_pipeline.run(spark, folder)


QUERIES = {f.__name__: f for f in (
    pipeline,
    op1_token_counts, op2_near_duplicates, op3_source_mix, op4_fingerprints, op5_language_id, op6_main_text, op7_embedding_near_duplicates, op8_warc_captures, op9_packing,
    op10_repeated_passages, op11_tokenizer_alignment, op12_conversation_repair, op13_personal_data)}

ORACLE_SQL: dict[str, str] = {
    "op7_embedding_near_duplicates": oracles.EMBEDDING_NEAR_DUPLICATES,
    "op8_warc_captures": oracles.WARC_CAPTURES,
    "op12_conversation_repair": oracles.CONVERSATION_REPAIR,
}
