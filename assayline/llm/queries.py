"""One query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from assayline import session

from . import bitplanes, bpe, bytecnn, contamination, fragments, interpolation, merkle, paragraphs, pii, repetition, simhash, sitetree, spelling, tokens, twins
from .frames import held_out, stage, table
from .registry import ORACLES, QUERIES, register

__all__ = ["ORACLES", "QUERIES"]


@register("op1_byte_bpe")
def byte_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN).drop("text")
    decoded = bpe.decode(encoded, ranks, public_tokenizers.PATTERN)
    return decoded.select("doc_id", "n_tokens", bpe.digest(F.col("token_ids")).alias("ids_sha256"), bpe.digest(F.col("decoded")).alias("decoded_sha256"))


@register("op2_site_tree")
def main_text(spark, sf_dir):
    found = sitetree.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@register("op3_interpolation")
def language_model(spark, sf_dir):
    return interpolation.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op4_personal_data")
def personal_data(spark, sf_dir):
    found = pii.judge(pii.located(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))
    return found.select(
        "doc_id", *[pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"),
    )


@register("op5_repetition")
def repeated_text(spark, sf_dir):
    judged = repetition.judge(repetition.measure(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_words", "longest_repeat",
    )


#: Below this probability a document counts as bad.
QUALITY = 0.3


@register("op9_quality")
def quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = bytecnn.fit_on(documents, table(spark, sf_dir, "labels"))
    scored = bytecnn.score(documents, net)
    return scored.select("doc_id", held_out(0).alias("held_out"), "score", (F.col("score") >= QUALITY).cast("int").alias("predicted"))


@register("op6_paragraphs")
def repeated_paragraphs(spark, sf_dir):
    return paragraphs.repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op7_simhash")
def near_duplicates(spark, sf_dir):
    prints = stage(simhash.with_fingerprint(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"), "documents")
    return prints.join(simhash.groups(prints), "fingerprint").select("doc_id", simhash.hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id")


@register("op8_bit_planes")
def bit_planes(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    in_order = bitplanes.ordered(documents, "doc_id", F.xxhash64("text"))
    ids = tokens.encode(in_order, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    path = session.scratch(spark, "token-ids")
    bitplanes.write(ids, path)
    return bitplanes.summary(spark, path)


@register("op10_decontamination")
def decontamination(spark, sf_dir):
    found = contamination.find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@register("op11_ngram_join", twins.NGRAM_JOIN)
def similar_texts(spark, sf_dir):
    return fragments.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op12_merkle_manifest", twins.MERKLE)
def merkle_manifest(spark, sf_dir):
    proved = merkle.proofs(merkle.manifest(table(spark, sf_dir, "documents")))
    return proved.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@register("op13_spelling_variants", twins.SPELLING)
def spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text")).select("word", "form", "root", "n", "n_near", "form_n")
