"""All queries of this subpackage."""

from landgrain.llm import dialogues, languages, licences, packing, pairs, periods, phrases, pieces, pseudonyms, signatures, topk, urls, warc  # noqa: F401
from landgrain.llm.book import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
