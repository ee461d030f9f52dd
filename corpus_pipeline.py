"""From raw documents to packed training sequences, a stage at a time.

Each stage takes (spark, docs, sf_dir) and returns what the next one reads. ``run`` writes every stage to the shared
folder before the next begins, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from linkloom.llm import common, decontaminate, lang_id, packing, simhash, substring


def language(spark, docs, sf_dir):
    """Documents whose language can be told stay; it is learnt from those that are not held out."""
    train = docs.where(common.fold() != 2).select("text", "lang")
    return lang_id.accepted(docs, train)


def near_dedup(spark, docs, sf_dir):
    """One document of each near-duplicate group stays."""
    return simhash.one_of_each(docs)


def substrings(spark, docs, sf_dir):
    """Passages that an earlier document has go."""
    return substring.cleaned(docs)


def benchmark(spark, docs, sf_dir):
    """Documents that contain a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark, docs, sf_dir):
    """Where each piece of each document lies."""
    return packing.packed(docs.select("doc_id", "text"))


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substrings),
    ("benchmark_decontamination", benchmark),
    ("packing", pack),
]

#: SQL cannot express the classifier, the fingerprints or the packing; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = common.documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.written(docs, name)
    return docs
