"""Imports every module of the package, so that its queries are registered."""

from ledgerloom.llm import bpe, chat, decontamination, embeddings, interaction, licenses, lines, merkle, pii, sharding, simhash, suffix_tree, toxicity  # noqa: F401
from ledgerloom.llm.common import ORACLE, QUERIES  # noqa: F401
