"""Importing this module registers every query of the subpackage."""

from larkspur.llm import (  # noqa: F401
    alignment,
    collocations,
    content_sort,
    jaccard_join,
    language,
    license_scan,
    lm_score,
    mixing,
    packing,
    quality_model,
    quality_rules,
    topk_search,
    url_filter,
)
from larkspur.llm.registry import ORACLES, QUERIES  # noqa: F401
