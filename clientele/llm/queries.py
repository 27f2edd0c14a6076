"""The registered queries: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from clientele.llm import alignment, bpe, cross_polytope, decontaminate, factorization, infill, licenses, lines, order_minhash, packing, reputation, sharding, token_counts
from clientele.llm.common import query, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
COUNTED = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = [f"shard-{i:03d}" for i in range(64)]


def page_outcomes(spark, folder):
    """A page counts as good if the label row of its number says so: of quality and not toxic."""
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")
    return table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"), good.alias("good"))


@query("op1_host_reputation", reputation.JUDGE_SQL)
def host_reputation(spark, folder):
    return reputation.judge(table(spark, folder, "pages"), page_outcomes(spark, folder))


@query("op2_cross_polytope")
def cross_polytope_search(spark, folder):
    return cross_polytope.search(table(spark, folder, "embeddings"))


@query("op3_factorization_machine")
def factorization_machine(spark, folder):
    docs = table(spark, folder, "documents")
    model = factorization.train(docs, table(spark, folder, "labels"))
    scored = factorization.score(docs, model)
    return scored.select("doc_id", factorization.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op4_order_minhash")
def order_min_hash(spark, folder):
    return order_minhash.classes(table(spark, folder, "documents"))


@query("op5_best_fit_packing")
def best_fit_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN, end=50256, pad=50256)


@query("op6_lookup_sharding")
def lookup_sharding(spark, folder):
    return sharding.place(table(spark, folder, "documents"), SHARDS)


@query("op7_bpe_transducer")
def bpe_transducer(spark, folder):
    return bpe.digests(table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN).withColumnRenamed("key", "doc_id")


@query("op8_prefix_containment", decontaminate.CONTAMINATION_SQL)
def prefix_containment(spark, folder):
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op9_segment_lines", lines.REPORT_SQL)
def segment_lines(spark, folder):
    return lines.report(table(spark, folder, "documents"))


@query("op10_license_scan")
def license_scan(spark, folder):
    found = licenses.scan(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


INFILL_SQL = """with t as (select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
    drawn as (select doc_id, text, length(text) as n, ('0x' || substr(h, 1, 8))::ubigint as h1, ('0x' || substr(h, 9, 8))::ubigint as h2,
        ('0x' || substr(h, 17, 8))::ubigint as h3, ('0x' || substr(h, 25, 8))::ubigint as h4 from t),
    placed as (select *, cast(least(h1 % (n + 1), h2 % (n + 1)) as bigint) as a, cast(greatest(h1 % (n + 1), h2 % (n + 1)) as bigint) as b,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from drawn),
    cut as (select *, substring(text, 1, a) as p, substring(text, a + 1, b - a) as m, substring(text, b + 1) as s from placed)
    select doc_id, n, form, case when form != 'plain' then a end as prefix_chars, case when form != 'plain' then b - a end as middle_chars,
        sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(text) as restored_sha256 from cut"""


@query("op12_boundary_infill", INFILL_SQL)
def boundary_infill(spark, folder):
    made = infill.fill_in_middle(table(spark, folder, "documents"))
    return made.select(
        F.col("key").alias("doc_id"), "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(infill.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@query("op11_two_tier_counts")
def two_tier_counts(spark, folder):
    counted = token_counts.count_tokens(table(spark, folder, "documents"), COUNTED, public_tokenizers.PATTERN)
    return counted.select(F.col("key").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@query("op13_fragment_alignment")
def fragment_alignment(spark, folder):
    found = alignment.align(table(spark, folder, "documents"), COUNTED, public_tokenizers.path("piece_bpe_32k.model"))
    return found.withColumnRenamed("key", "doc_id")
