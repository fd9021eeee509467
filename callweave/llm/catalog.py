"""Importing this module registers the queries of this subpackage."""

from callweave.llm import divergence, embed, jaccard, langid, licenses, line_dedup, mixing, ngrams, pieces, quality, secrets, suffix, whitening  # noqa: F401
from callweave.llm.registry import ORACLES, QUERIES  # noqa: F401
