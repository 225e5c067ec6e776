"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread as the next one's input.

1. language ID       documents whose language is not recognised go (null texts, texts without letters, foreign ones)
2. exact dedup       of equal texts the row with the largest doc_id stays
3. near dedup        of each group of near-duplicates the document with the smallest doc_id stays
4. mixing            sources are flattened by temperature until one is repeated MOST_EPOCHS times as often as another; the
                     covering budget shows every document at least once, so nothing is lost, and repeats rows of small sources
5. packing           windows of at most 2048 tokens, one row per piece

ORACLE_SQL is None: SQL can't train the classifier, sign the texts or tokenise them; the stages are tested against
brute force instead.
"""

from __future__ import annotations

import public_tokenizers

from recspark.llm import exact_dedup, langid, mixing, near_dedup, packing
from recspark.llm.common import documents
from recspark.session import materialize

ORACLE_SQL = None
MOST_EPOCHS = 1.25
#: packing runs beside a heap that the stages before have filled, so its workers hold less than the operator's defaults
SLICE_BYTES, CACHED_PIECES = 8 << 20, 200_000


def language_id(spark, docs, sf_dir):
    return langid.keep_known_languages(docs, langid.fit_language_model(docs))


def exact_copies(spark, docs, sf_dir):
    return exact_dedup.keep_first_copies(docs)


def near_copies(spark, docs, sf_dir):
    return near_dedup.keep_representatives(docs, keep_blank=True)


def mixture(spark, docs, sf_dir):
    return mixing.mixed_documents(docs, most_epochs=MOST_EPOCHS, budget="cover")


def windows(spark, docs, sf_dir):
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), slice_bytes=SLICE_BYTES, cached_pieces=CACHED_PIECES)


STAGES = [("language_id", language_id), ("exact_dedup", exact_copies), ("near_dedup", near_copies), ("mixing", mixture), ("packing", windows)]


def run(spark, sf_dir):
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
