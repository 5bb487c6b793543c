"""The corpus operators as queries, and their SQL where SQL can express them."""

from __future__ import annotations

from . import centroid_clustering, chat_formatting, conversation_trie, decontamination, ngram_jaccard, source_mixing, substring_dedup, suffix_dedup, url_filter
from .centroid_clustering import op12_centroid_clustering
from .chat_formatting import op6_chat_formatting
from .conversation_trie import op13_conversation_trie
from .decontamination import op1_decontamination
from .language_id import op9_language_id
from .lm_scoring import op7_lm_scoring
from .media_columns import op10_media_columns
from .ngram_jaccard import op3_ngram_jaccard
from .source_mixing import op5_source_mixing
from .substring_dedup import op8_substring_dedup
from .suffix_dedup import op11_suffix_dedup
from .toxicity import op4_toxicity
from .url_filter import op2_url_filter

QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_url_filter, op3_ngram_jaccard, op4_toxicity, op5_source_mixing,
        op6_chat_formatting, op7_lm_scoring, op8_substring_dedup, op9_language_id, op10_media_columns, op11_suffix_dedup, op12_centroid_clustering, op13_conversation_trie,
    )
}

ORACLES = {
    "op1_decontamination": decontamination.ORACLE,
    "op2_url_filter": url_filter.ORACLE,
    "op3_ngram_jaccard": ngram_jaccard.ORACLE,
    "op5_source_mixing": source_mixing.ORACLE,
    "op6_chat_formatting": chat_formatting.ORACLE,
    "op8_substring_dedup": substring_dedup.ORACLE,
    "op11_suffix_dedup": suffix_dedup.ORACLE,
    "op12_centroid_clustering": centroid_clustering.ORACLE,
    "op13_conversation_trie": conversation_trie.ORACLE,
}
