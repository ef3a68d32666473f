"""The queries of this subpackage, and the SQL that states their results where SQL can."""

from __future__ import annotations

import corpus_pipeline

from .bpe import op3_bpe
from .centroids import OP12_SQL, op12_centroid_clustering
from .chat import OP6_SQL, op6_chat_formatting
from .embedding_dedup import OP8_SQL, op8_embedding_dedup
from .hnsw import op7_nearest_neighbours
from .langid import op1_language_id
from .mixing import OP9_SQL, op9_mixing
from .pieces import op11_sentencepiece
from .quality import op5_quality
from .secrets import op4_secret_scans
from .simhash import op2_simhash
from .urls import op10_url_filters
from .whitening import op13_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_simhash,
        op3_bpe,
        op4_secret_scans,
        op5_quality,
        op6_chat_formatting,
        op7_nearest_neighbours,
        op8_embedding_dedup,
        op9_mixing,
        op10_url_filters,
        op11_sentencepiece,
        op12_centroid_clustering,
        op13_whitening,
    )
} | {"pipeline": corpus_pipeline.run}

ORACLE = {
    "op6_chat_formatting": OP6_SQL,
    "op8_embedding_dedup": OP8_SQL,
    "op9_mixing": OP9_SQL,
    "op12_centroid_clustering": OP12_SQL,
}
