"""Importing this module registers the queries of all operators."""

from tripengine.llm import (  # noqa: F401
    bpe,
    decontaminate,
    exact,
    jaccard,
    langid,
    licences,
    lm,
    pii,
    quality,
    runs,
    tokens,
    vectors,
    warc,
)
from tripengine.llm.common import QUERIES  # noqa: F401
