"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from . import (centroid_clusters, chat_format, conversation_repair, embedding_dedup, jaccard_join, language_id,
               quality_classifier, secret_scan, sentencepiece_codec, template_decontamination, token_scan, warc_files,
               wavelet_files)

_MODULES = (sentencepiece_codec, embedding_dedup, token_scan, quality_classifier, language_id, template_decontamination,
            wavelet_files, jaccard_join, warc_files, chat_format, conversation_repair, secret_scan, centroid_clusters)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in getattr(module, "ORACLE", {}).items()}
