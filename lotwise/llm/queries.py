"""All registered queries of the operators."""

from lotwise.llm import chat, decontamination, edit_prints, language_model, licenses, minhash, mixing, periodic, phrases, quality, sharding, simhash, substrings  # noqa: F401
from lotwise.llm.base import ORACLES, QUERIES  # noqa: F401
