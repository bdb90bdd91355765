"""Imports every module of this subpackage that registers a query."""

from pelagia.llm import (chat, contamination, fingerprint, langid, lexical, mixing, neardup, simhash, spelling,  # noqa: F401
                         substrings, suffixes, tokens, toxicity)
from pelagia.llm.registry import ORACLES, QUERIES  # noqa: F401
